"""Line deduplication: one copy of every line in the corpus.

Lines are exploded with their position, hashed by a normalised key and counted by
documents; the surplus lines go, the others are put together by position. All
of it is DataFrame work.

Shuffles: the 128-bit keys (not the lines), the positions that go, and each
text once. A key in a third of all documents is summed before its shuffle; the
join that finds its lines again is split by adaptive skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of a line's ends, as the fixed class [\x20\x09-\x0D].
SPACE = " \t\n\x0b\f\r"
MIN_KEY_CHARS = 10
_LAST = 2**63 - 1


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.btrim(line, F.lit(SPACE)), upper, upper.lower())


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_KEY_CHARS
) -> DataFrame:
    """``docs`` with ``text_col`` thinned, and two columns ``n_lines`` and ``n_dropped``.

    A key of at least ``min_chars`` code points that at least two documents hold
    loses all its lines but those of the smallest id. Shorter lines always stay.

    - Null or empty text: one empty line; the new text is empty.
    - Null id: it counts as the largest id; all such rows are one document.
    - Rows with the same id are one document: a line they share stays in all of them.
    - A document that loses every line keeps an empty text.
    - Extra columns pass through; columns named like the two new ones are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.coalesce(F.col(f"`{id_col}`"), F.lit(_LAST)).alias("doc"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("body"),
    ).withColumn("body_hash", F.xxhash64("body"))

    lines = (
        rows.select("doc", "body_hash", F.posexplode(F.split("body", "\n")).alias("pos", "line"))
        .select("doc", "body_hash", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select("doc", "body_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    shared = (
        lines.groupBy("h1", "h2")
        .agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
        .where("first_doc <> last_doc")
        .select("h1", "h2", "first_doc")
    )
    surplus = (
        lines.join(shared, ["h1", "h2"])
        .where("doc <> first_doc")
        .groupBy("doc", "body_hash")
        .agg(F.collect_list("pos").alias("gone"))
    )
    body_lines = F.split("body", "\n")
    out = (
        rows.join(surplus, ["doc", "body_hash"], "left")
        .withColumn("lines", body_lines)
        .withColumn(
            "stay",
            F.when(
                F.col("gone").isNotNull(),
                F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"),
            ),
        )
        .withColumn(
            "new_body",
            F.when(F.col("stay").isNull(), F.col("body")).otherwise(
                F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n")
            ),
        )
    )
    return out.select(
        *[(F.col("new_body") if c == text_col else F.col("row").getField(c)).alias(c) for c in kept],
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("stay").isNull(), 0).otherwise(F.size("lines") - F.size("stay")).cast("long").alias("n_dropped"),
    )


ORACLE = """
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
    from documents
), keyed as (
    select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
), firsts as (
    select key, min(doc_id) as first_doc from keyed where length(key) >= 10
    group by key having count(distinct doc_id) >= 2
), judged as (
    select k.*, f.first_doc is not null and f.first_doc <> k.doc_id as gone
    from keyed k left join firsts f using (key)
)
select doc_id, count(*) as n_lines, sum(gone::int)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
"""
