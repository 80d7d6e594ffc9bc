"""Quality rules with a log-likelihood-ratio verdict, in DataFrame expressions only.

Two multinomials over hashed word n-grams are estimated: one from trusted
documents, one from the whole raw corpus. A document's verdict is the sum of
log(target / raw) over its n-grams, divided by their number, against a fixed
threshold. Plain counting rules come first.

The corpus is read twice, once to count and once to judge; nothing but bucket
counts is shuffled. The model has ``BUCKETS`` numbers, so its size is fixed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
THRESHOLD = -0.1
#: Added to each bucket's count, in both multinomials.
SMOOTHING = 0.5
#: Ids of trusted documents used at most; they are broadcast, 8 bytes each.
MAX_TRUSTED = 100_000
SPACE = " \t\n\x0b\f\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _words(text: Column) -> Column:
    """Runs of ``[^\\x20\\x09-\\x0D]``; an empty array when there are none."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def _runs(hashes: str, size: int) -> Column:
    """Hashes of all runs of ``size`` neighbouring words."""
    places = F.sequence(F.lit(0), F.size(hashes) - size)
    run = F.transform(places, lambda i: F.xxhash64(F.get(hashes, i), *[F.get(hashes, i + k) for k in range(1, size)]))
    return F.when(F.size(hashes) >= size, run).otherwise(F.array().cast("array<bigint>"))


def with_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``_body``, ``_words`` and ``_h``, the words' hashes."""
    return (
        docs.withColumn("_body", F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
        .withColumn("_words", _words(F.col("_body")))
        .withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    )


def _buckets(buckets: int) -> Column:
    """Buckets of a document's single words and neighbouring pairs."""
    def bucket(h: Column) -> Column:
        return F.pmod(h, F.lit(buckets)).cast("int")

    # The following word is null after the last one, and a hash passes nulls over.
    pairs = F.transform("_h", lambda h, i: bucket(F.xxhash64(h, F.get("_h", i + 1))))
    return F.concat(F.transform("_h", bucket), F.slice(pairs, 1, F.greatest(F.size("_h") - 1, F.lit(0))))


def base_counts(worded: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    A text's repeated 3-word windows are found by sorting its own window hashes;
    texts without any skip the sort.
    """
    lines = F.filter(F.split("_body", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
    sorted_runs = F.sort_array(F.transform("_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.filter(
        F.transform(
            "_sorted",
            lambda x, k: F.when(
                (x["h"] == F.get("_sorted", k + 1)["h"]) | (x["h"] == F.get("_sorted", k - 1)["h"]), x["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    covered = F.array_distinct(F.flatten(F.transform("_twice", lambda i: F.array(i, i + 1, i + 2))))
    return (
        worded.withColumn("_lines", lines)
        .withColumn("_runs", _runs("_h", 3))
        .withColumn("_sorted", F.when(F.size(F.array_distinct("_runs")) < F.size("_runs"), sorted_runs))
        .withColumn("_twice", F.when(F.col("_sorted").isNotNull(), twice))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count("_body", F.lit("[#*$%&|<>]")).cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", F.when(F.col("_twice").isNull(), 0).otherwise(F.size(covered)).cast("long"))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
    )


def fit_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> list[float]:
    """log(target / raw) of every bucket: ``buckets`` numbers, all that reaches the driver.

    ``trusted`` has one column ``_trusted``, distinct ids of at most MAX_TRUSTED documents.
    """
    rows = with_words(docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")), "_text")
    marked = rows.select("_id", _buckets(buckets).alias("_b")).join(
        F.broadcast(trusted), F.col("_id") == F.col("_trusted"), "left"
    )
    counts = (
        # Outer, since a plain explode makes the optimizer repeat the array's whole expression in a filter.
        marked.select(F.explode_outer("_b").alias("b"), F.col("_trusted").isNotNull().cast("long").alias("t"))
        .where("b is not null")
        .groupBy("b")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target"))
    )
    found = counts.collect()
    raw, target = [0] * buckets, [0] * buckets
    for row in found:
        raw[row.b], target[row.b] = row.raw, row.target
    spread = SMOOTHING * buckets
    base = math.log(sum(raw) + spread) - math.log(sum(target) + spread)
    return [
        round(base + math.log((t + SMOOTHING) / (r + SMOOTHING)), 6) for r, t in zip(raw, target)
    ]


def apply_rules(
    docs: DataFrame,
    ratios: list[float],
    threshold: float = THRESHOLD,
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the base counts, ``ratio`` (mean log-likelihood ratio per n-gram) and ``kept``.

    - Null or empty text: no words, all counts 0, ratio 0, base_failed, not kept.
    - No trusted document, or an empty corpus: the ratios are those of smoothing alone.
    - Ties and repeated rows are judged alike; extra columns stay, a column with
      the name of a result is replaced.
    """
    # One constant array, folded by the optimizer; its size is the number of buckets.
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    score = F.aggregate("_b", F.lit(0.0), lambda total, b: total + F.get(table, b))
    made = base_counts(with_words(docs, text_col)).withColumn("_b", _buckets(len(ratios)))
    return (
        made.withColumn("ratio", F.when(F.size("_b") > 0, score / F.size("_b")).otherwise(0.0))
        .withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold))
        .drop("_body", "_words", "_h", "_lines", "_runs", "_sorted", "_twice", "_b")
    )


def trusted_ids(labels: DataFrame, limit: int = MAX_TRUSTED) -> DataFrame:
    """At most ``limit`` ids that ``labels`` marks as of good quality, chosen by hash."""
    return (
        labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("_trusted"))
        .distinct()
        .orderBy(F.xxhash64("_trusted"), "_trusted")
        .limit(limit)
    )
