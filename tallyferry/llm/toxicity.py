"""Toxicity: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

A document's features are its distinct words and their stems, neighbouring pairs
and pairs with one word between, hashed to ``1 << BITS`` coordinates. Learning visits a bounded
sample of labelled documents in a fixed random order; each coordinate has its own
rate, and L1 keeps most weights at exactly zero. The few others are broadcast
inside the scoring function: at most ``1 << BITS`` numbers, in practice thousands.

Scoring is one pass over the texts without any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyferry.llm.bytesview import Slice, chain, mix, same_doc, slices, words
from tallyferry.llm.labelled import training_sample

BITS = 20
#: Labelled documents learned from at most.
FIT_ROWS = 16_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 0.3, 1.0, 4.0, 0.0
THRESHOLD = 0.5
#: Stems: a word's first bytes, so that inflected words share what they have in common.
STEMS = (4, 5, 6, 7, 8)
_SKIP = np.uint64(0xD6E8FEB86659FD93)


def features(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Document and coordinate of every feature in a slice, repeats included."""
    found = words(part, lower=True, letters=True, stems=STEMS)
    h, doc = found.hashes, found.doc
    near, far = same_doc(doc, 2), same_doc(doc, 3)
    skip = mix(h[:-2] * _SKIP + h[2:]) if len(h) > 2 else h[:0]
    all_h = np.concatenate([h, chain(h, 2)[near], skip[far], *[x for _, x in found.stems]])
    all_doc = np.concatenate([doc, doc[: len(near)][near], doc[: len(far)][far], *[doc[k] for k, _ in found.stems]])
    return all_doc, (all_h >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """The learner: sums of gradients and of their squares per coordinate; the last one is the bias."""

    def __init__(self) -> None:
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == 1 << BITS, 0.0, L1)
        w = (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > l1, w, 0.0)

    def learn(self, at: np.ndarray, label: int) -> None:
        """One step on the distinct coordinates of a document."""
        w = self.weights(at)
        error = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += error - (np.sqrt(n + error * error) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + error * error


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = FIT_ROWS) -> list[tuple[int, float]]:
    """Coordinates and weights other than zero.

    Learns from ``training_sample`` in one task, which its bound of ``limit``
    documents allows. Without labelled rows there are no weights.
    """
    sample = training_sample(docs, labels, label, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Few large arrays, so that all of it goes back to the system when the task ends.
        flat, ends, known = [np.empty(0, np.int32)], [0], []
        for batch in batches:
            for part in slices(batch.column(0)):
                doc, at = features(part)
                order = np.argsort(doc, kind="stable")
                cuts = np.searchsorted(doc[order], np.arange(len(part.starts) + 1))
                at = at[order]
                distinct = [np.append(np.unique(at[a:b]), 1 << BITS) for a, b in zip(cuts[:-1], cuts[1:])]
                flat.append(np.concatenate(distinct).astype(np.int32))
                ends += (ends[-1] + np.cumsum([len(d) for d in distinct])).tolist()
                known += batch.column(1)[part.first : part.first + len(distinct)].to_pylist()
        every = np.concatenate(flat)
        flat.clear()
        learner = Ftrl()
        for _ in range(EPOCHS):
            for a, b, y in zip(ends[:-1], ends[1:], known):
                learner.learn(every[a:b], y)
        w = learner.weights(np.arange((1 << BITS) + 1))
        there = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(w[there])], names=["at", "weight"])

    in_order = sample.withColumn("_at", F.xxhash64("doc_id", F.lit(6))).repartition(1)
    in_order = in_order.sortWithinPartitions("_at", "doc_id", "text").select("text", "label")
    return [(r.at, r.weight) for r in in_order.mapInArrow(run, "at long, weight double").collect()]


def score(docs: DataFrame, weights: list[tuple[int, float]], text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, the likelihood of being toxic.

    - Null and empty texts have no features: the score of the bias alone.
    - Without weights every score is 0.5. Repeated rows and ties score alike.
    - Texts are read whole, whatever their length. A column named ``score`` is
      replaced, other columns pass through; an empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c != "score"]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = StructType([*rows.schema.fields]).add("score", "double")
    place = kept.index(text_col)
    at = np.array([a for a, _ in weights], np.int64)
    values = np.array([w for _, w in weights])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((1 << BITS) + 1, np.float32)
        table[at] = values
        for batch in batches:
            logits = [np.empty(0)]
            for part in slices(batch.column(place)):
                doc, found = features(part)
                there = table[found] != 0
                pairs = np.unique((doc[there] << BITS) | found[there])
                sums = np.bincount(pairs >> BITS, table[pairs & ((1 << BITS) - 1)], len(part.starts))
                logits.append(sums + table[1 << BITS])
            result = 1 / (1 + np.exp(-np.clip(np.concatenate(logits), -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(result)], names=[*kept, "score"])

    return rows.mapInArrow(run, schema)
