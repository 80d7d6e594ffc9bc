"""Periodic run detection: stretches of words that repeat with a short period.

Seed and extend on diagonals, text by text. A run of period q and at least 4q words
matches itself, q words on, over at least 3q words. For periods from 2^b until
2^(b+1) that is at least 3 * 2^b words, the minimum guaranteed overlap: every run has
a k-gram of that length that comes again exactly q words on. Since k >= q, an
occurrence in between would give the run a smaller period, so the next occurrence of
a k-gram is the one to look at, and pairs of neighbouring occurrences are enough:
one per position and band, never all pairs.

Each pair whose lag is in the band lies on a diagonal. Unless an earlier extension on
that lag already went past it (a table of how far each lag is covered), it is extended
to both sides by comparing words. k-grams are ranks of pairs of shorter k-grams, so
equal ranks are equal words; no hash decides anything but that a text has no repeated
5-gram and so no run.

No shuffle: a text is worked by the task that read it, in n log n steps.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 6
MIN_EXPONENT = 4
#: Overlap that the shortest run of any period has with itself: 6 words of period 1.
SEED = MIN_WORDS - 1
_BASE = np.int64(0x9E3779B97F4A7C15 - (1 << 64))


class Run(NamedTuple):
    """A maximal stretch of words with its smallest period."""

    start: int
    length: int
    period: int


def word_ids(words: list) -> np.ndarray:
    """A number for each different word."""
    numbers: dict = {}
    return np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)


def runs_of(ids: np.ndarray) -> list[Run]:
    """All runs of a sequence of word numbers, by start, then period."""
    n = len(ids)
    if n < MIN_WORDS or not _repeats_a_seed(ids):
        return []
    found: list[Run] = []
    three = _joined(_joined(ids, ids, 1), ids, 2)
    seeds = _joined(three, _joined(ids, ids, 1), 3)
    _extend_pairs(ids, seeds, 1, 2, found)
    grams, size, low = _joined(three, three, 3), 6, 2
    while MIN_EXPONENT * low <= n and len(grams):
        if not _extend_pairs(ids, grams, low, 2 * low, found):
            break
        grams, size, low = _joined(grams, grams, size), 2 * size, 2 * low
    return sorted(found)


def _repeats_a_seed(ids: np.ndarray) -> bool:
    """Whether any 5-gram may come twice; false only when none does."""
    mixed = ids[: len(ids) - SEED + 1].copy()
    for k in range(1, SEED):
        mixed = (mixed ^ (mixed >> np.int64(29))) * _BASE + ids[k : len(ids) - SEED + 1 + k]
    mixed.sort()
    return bool((mixed[1:] == mixed[:-1]).any())


def _joined(left: np.ndarray, right: np.ndarray, apart: int) -> np.ndarray:
    """Ranks of the grams made of ``left`` at i and ``right`` at i + apart."""
    n = min(len(left), len(right) - apart)
    if n <= 0:
        return np.empty(0, np.int64)
    pairs = left[:n] * (right.max() + 1) + right[apart : apart + n]
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64)


def _extend_pairs(ids: np.ndarray, grams: np.ndarray, low: int, high: int, found: list[Run]) -> bool:
    """Extend neighbouring occurrences ``low`` to ``high`` - 1 words apart; whether any gram came twice."""
    order = np.argsort(grams, kind="stable")
    again = grams[order[1:]] == grams[order[:-1]]
    if not again.any():
        return False
    first, lags = order[:-1][again], (order[1:] - order[:-1])[again]
    inside = (lags >= low) & (lags < high)
    first, lags = first[inside], lags[inside]
    by_place = np.argsort(first, kind="stable")
    first, lags = first[by_place], lags[by_place]
    covered: dict[int, int] = {}
    for at, lag in zip(first.tolist(), lags.tolist()):
        if covered.get(lag, -1) > at:
            continue
        end = at + _agreement(ids[at:], ids[at + lag :])
        start = at - _agreement(ids[:at][::-1], ids[: at + lag][::-1])
        covered[lag] = end + 1
        length = end + lag - start
        if length >= max(MIN_WORDS, MIN_EXPONENT * lag):
            found.append(Run(start, length, lag))
    return True


def _agreement(a: np.ndarray, b: np.ndarray) -> int:
    """How many words from the start of both are the same."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        to = min(at + step, n)
        differ = a[at:to] != b[at:to]
        if differ.any():
            return at + int(differ.argmax())
        at, step = to, 2 * step
    return n


def planted_words(doc_id: int | None, words: list) -> list:
    """The words with a periodic tail in one text of ten, chosen by the CRC of the id; a null id changes none."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    times = -(-(n - start) // period)
    return words[:start] + (words[start : start + period] * times)[: n - start]


def collapsed(words: list, runs: list[Run]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words), bool)
    for run in runs:
        gone[run.start + run.period : run.start + run.length] = True
    return [w for w, dropped in zip(words, gone.tolist()) if not dropped]


def longest(runs: list[Run]) -> Run | None:
    """The run of greatest length; the smallest start, then period, of several."""
    return min(runs, key=lambda r: (-r.length, r.start, r.period), default=None)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """Each document with its runs and its text without repeated periods.

    Columns: the id as ``doc_id``, ``runs`` (array of start, length, period by start, then
    period; word numbers from 0) and ``collapsed`` (words that stay, joined by one space).
    ``plant`` replaces the tail of one text of ten by a periodic one first (``planted_words``).

    - Null, empty or blank text: no words, no runs, empty ``collapsed``.
    - Null id: worked like any other, never planted. Rows with the same id are each worked alone.
    - Runs of different periods may overlap; each is reported. Long texts are worked whole.
    - An empty table gives no rows. Extra columns are not read, whatever their names.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                ids = part.column(0).to_pylist()
                found, texts = [], []
                for doc_id, text in zip(ids, part.column(1)):
                    # bytes.split() cuts at exactly the six ASCII white space characters.
                    words = (text.as_py() or "").encode().split()
                    if plant:
                        words = planted_words(doc_id, words)
                    runs = runs_of(word_ids(words)) if len(words) >= MIN_WORDS else []
                    found.append([r._asdict() for r in runs])
                    texts.append(b" ".join(collapsed(words, runs)))
                columns = [pa.array(ids, pa.int64()), pa.array(found, run_type), pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "runs", "collapsed"])

    schema = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return rows.mapInArrow(work, schema)


def digests(found: DataFrame) -> DataFrame:
    """What the runs of ``find_runs`` come to: their number, the longest one and two hashes."""
    best = F.expr("array_min(transform(runs, r -> struct(-r.length as less, r.start as start, r.period as period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * -best.less) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
