"""The queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyferry.llm import (
    bpe_automaton, conversation_repair, html_text, line_dedup, mixing, ngram_join, order_minhash, periodic_runs, quality_rank, quality_rules,
    simhash_join, token_files, toxicity,
)
from tallyferry.llm.labelled import held_out
from tallyferry.session import scratch_path

QUERIES = {}
ORACLES = {}


def _query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def tokenizer_path() -> str:
    """The byte-level vocabulary file of the public tokenizers package, at the same place on all machines."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


@_query()
def op1_html_text(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of each page."""
    pages = _read(spark, sf, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", "n_chars")


@_query()
def op2_quality_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of each document."""
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    ranking = quality_rank.fit(docs, _read(spark, sf, "labels"))
    return quality_rank.score(docs, ranking).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= quality_rank.THRESHOLD).cast("int").alias("predicted"),
    )


@_query()
def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity score of each document."""
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    weights = toxicity.fit(docs, _read(spark, sf, "labels"))
    return toxicity.score(docs, weights).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@_query()
def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Words that a mix by source weights takes of each document, and the shards that get them."""
    docs = _read(spark, sf, "documents").select("doc_id", "source", "text")
    plan = mixing.plan_mix(docs)
    return plan.select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
        (F.size("draws") * F.col("size")).cast("long").alias("taken"),
        F.array_join(F.transform("draws", lambda d: d.shard.cast("string")), ",").alias("shards"),
    )


@_query()
def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Counts, base rules and the likelihood-ratio verdict of each document."""
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    trusted = quality_rules.trusted_ids(_read(spark, sf, "labels"))
    judged = quality_rules.apply_rules(docs, quality_rules.fit_ratios(docs, trusted))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio"
    )


@_query(line_dedup.ORACLE)
def op6_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without the lines that an earlier document holds."""
    thin = line_dedup.dedup_lines(_read(spark, sf, "documents").select("doc_id", "text"))
    return thin.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@_query()
def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """Where each document's ids lie in the token files, and their checksum."""
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    folder = scratch_path(spark, "token-files")
    manifest = token_files.write_token_files(docs, folder, tokenizer_path())
    return token_files.read_token_files(spark, folder, manifest)


@_query()
def op8_order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of each document, of its edited text, and how alike they are."""
    return order_minhash.compare_neighbours(_read(spark, sf, "documents"))


@_query()
def op9_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of documents that share most of their 4-word shingles."""
    return ngram_join.linked_components(_read(spark, sf, "documents"), size=4, percent=85)


@_query()
def op10_bpe_automaton(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of each document's ids and of the text decoded from them."""
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    return bpe_automaton.round_trip_digests(docs, tokenizer_path())


@_query()
def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Faults, cheapest repair and repaired text of each damaged conversation."""
    turns = conversation_repair.damage(conversation_repair.turns_of(_read(spark, sf, "conversations")))
    return conversation_repair.repair_digests(turns, conversation_repair.plan_repairs(turns)).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


@_query()
def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Periodic runs of each document, one in ten with a planted tail, and its collapsed text."""
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    return periodic_runs.digests(periodic_runs.find_runs(docs, plant=True))


@_query()
def op13_simhash_join(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint of each document and the group it is linked into."""
    found = simhash_join.near_duplicates(_read(spark, sf, "documents"))
    return found.select("doc_id", simhash_join.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")
