"""Order MinHash fingerprints, sensitive to edit distance.

A text's k-mers are numbered by occurrence, so repeats differ. For each of
``SKETCHES`` hash functions the ``TUPLE`` smallest numbered k-mers are taken, put back
into text order and hashed as a tuple. Two texts agree in a component when they
share those k-mers in the same order, which moving text around destroys. The
likeness of two fingerprints is the share of components that agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyferry.llm.bytesview import mix
from tallyferry.session import materialise

K = 6
TUPLE = 2
SKETCHES = 64
_ODD = mix(np.arange(11, 11 + SKETCHES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_ODD = _ODD.astype(np.uint32)
_COUNT = np.uint64(0xD1B54A32D192ED03)
_STEP = np.uint64(0x9FB21C651E98DF25)
_LAST = np.uint32((1 << 32) - 1)


def _kmers(data: np.ndarray) -> np.ndarray:
    """Hashes of all runs of K bytes; a shorter text is one k-mer, an empty one has none."""
    if not len(data):
        return np.empty(0, np.uint64)
    if len(data) < K:
        data = np.concatenate([data, np.full(K - len(data), 256, np.uint16)])
    n = len(data) - K + 1
    out = data[:n].astype(np.uint64)
    for i in range(1, K):
        out = out * np.uint64(257) + data[i : n + i]
    return mix(out * _STEP)


def sketch(text: str) -> np.ndarray:
    """``SKETCHES`` unsigned 16-bit numbers; all 0 for an empty text."""
    kmers = _kmers(np.frombuffer(text.encode(), np.uint8))
    n = len(kmers)
    if not n:
        return np.zeros(SKETCHES, np.uint16)
    bits = np.uint64(n.bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    packed = np.sort((kmers & ~low) | np.arange(n, dtype=np.uint64))
    place, kind = (packed & low).astype(np.int64), packed >> bits
    rank = np.arange(n)
    first = np.maximum.accumulate(np.where(np.append(True, kind[1:] != kind[:-1]), rank, 0))
    numbered = np.empty(n, np.uint64)
    numbered[place] = (rank - first).astype(np.uint64)
    # Multiplying by an odd number permutes 32-bit integers: one cheap hash function each.
    numbered = (mix(kmers + numbered * _COUNT) >> np.uint64(32)).astype(np.uint32)
    chosen = np.empty((SKETCHES, min(TUPLE, n)), np.int64)
    for j, odd in enumerate(_ODD):
        order = numbered * odd
        for c in range(chosen.shape[1]):
            at = order.argmin()
            order[at] = _LAST
            chosen[j, c] = at
    chosen.sort(axis=1)
    value = kmers[chosen[:, 0]]
    for c in range(1, chosen.shape[1]):
        value = mix(value * _STEP + kmers[chosen[:, c]])
    return (value >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of components that agree."""
    return float(np.count_nonzero(a == b)) / SKETCHES


def text_of(fingerprint: np.ndarray) -> str:
    """A fingerprint as lowercase hex."""
    return fingerprint.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``, 4 hex digits per component; no shuffle.

    Null and empty texts: all zeros. Equal texts have equal fingerprints. Extra
    columns pass through, one named ``fingerprint`` is replaced.
    """
    kept = docs.drop("fingerprint")

    @F.pandas_udf("string")
    def hashed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: text_of(sketch(t or "")))

    return kept.withColumn("fingerprint", hashed(F.col(f"`{text_col}`")))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_FIRST, _LAST_ROW, _DONE = 1, 2, 0


def _compared(doc_id, text: str, own: np.ndarray, following: str, theirs: np.ndarray) -> tuple:
    changed = edited(text, following)
    other = sketch(changed)
    return (
        doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), text_of(own), text_of(other),
        likeness(own, other), likeness(own, theirs),
    )


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's.

    The corpus is shuffled once, into id order, and each partition is read as a
    stream that remembers one document. The last document of a partition meets
    the first of the next one afterwards: two rows per partition.

    - Null or empty text: 0 characters, a zero fingerprint; likeness of two empty texts is 1.
    - Null id: first in order. Rows with the same id: in order of their texts.
    - A single document is followed by itself. An empty table: no rows. Extra columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        before = None
        for batch in batches:
            found = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                own = sketch(text)
                if before is None:
                    found.append((doc_id, *[None] * 6, part, _FIRST, text))
                else:
                    found.append((*_compared(*before, text, own), part, _DONE, None))
                before = (doc_id, text, own)
            yield _batch(found)
        if before is not None:
            yield _batch([(before[0], *[None] * 6, part, _LAST_ROW, before[1])])

    made = materialise(ordered.mapInArrow(run, _COLUMNS + ", part int, role int, text string"), "fingerprints")
    done = made.where(F.col("role") == _DONE).select(*[c.split()[0] for c in _COLUMNS.split(", ")])
    return done.union(_across(spark, made))


def _batch(found: list[tuple]) -> pa.RecordBatch:
    names = [*[c.split()[0] for c in _COLUMNS.split(", ")], "part", "role", "text"]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(types)], names=names)


def _across(spark: SparkSession, made: DataFrame) -> DataFrame:
    """The last document of each partition, compared with the first of the next that has any."""
    parts = sorted(r.part for r in made.where(F.col("role") == _FIRST).select("part").collect())
    following = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    last = made.where(F.col("role") == _LAST_ROW).select("part", "doc_id", "text")
    first = made.where(F.col("role") == _FIRST).select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _COLUMNS.split(", ")]
        for batch in batches:
            found = [
                _compared(None if pd.isna(r.doc_id) else int(r.doc_id), r.text, sketch(r.text), r.next_text, sketch(r.next_text))
                for r in batch.itertuples()
            ]
            out = pd.DataFrame(found, columns=names)
            yield out.assign(doc_id=out.doc_id.astype("Int64"))

    return last.join(following, "part").join(first, "next_part").select("doc_id", "text", "next_text").mapInPandas(run, _COLUMNS)
