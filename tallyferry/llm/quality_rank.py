"""Quality by Bradley-Terry ranking.

A document is a short vector of counts and shares. A score w.x is learned from
preference pairs: a document labelled good beats one labelled bad with
likelihood 1 / (1 + exp(-w.(x_good - x_bad))), so the logistic loss on feature
differences is minimised. Scores become decisions at a quantile of the training
scores, the one that the labels agree with best; the reported score is a logistic
curve through that point, which is scaled to lie at ``THRESHOLD``.

Learning reads a bounded sample of labelled documents. Scoring is one pass
over the texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tallyferry.llm.bytesview import Slice, chain, same_doc, slices, words
from tallyferry.llm.labelled import training_sample

#: Labelled documents learned from at most, and preference pairs made of them at most.
FIT_ROWS = 30_000
MAX_PAIRS = 300_000
THRESHOLD = 0.3
L2 = 1e-3
STEPS = 40
#: Bytes counted: upper case, lower case, digits, symbols, full stops and commas, bars, exclamation marks, line ends.
CLASSES = (
    range(65, 91), range(97, 123), range(48, 58), b"#*$%&<>@^~=+\\/_{}[]", b".,;:", b"|", b"!?", b"\n",
)


def features(part: Slice) -> np.ndarray:
    """One row per document of a slice. A text without words is all zeros."""
    n_docs = len(part.starts)
    found = words(part)
    doc, h = found.doc, found.hashes
    n_words = np.bincount(doc, minlength=n_docs)
    per_word = 1 / np.maximum(n_words, 1)
    size = np.bincount(doc, found.ends - found.starts, n_docs)
    kinds = np.zeros(256, np.uint8)
    for k, members in enumerate(CLASSES, 1):
        kinds[list(members)] = k
    at = kinds[part.data]
    counts = []
    for k in range(1, len(CLASSES) + 1):
        sums = np.zeros(len(at) + 1, np.int64)
        np.cumsum(at == k, out=sums[1:])
        counts.append(sums[part.ends] - sums[part.starts])
    upper, lower, digits, symbols, stops, bars, marks, lines = counts

    def distinct(docs: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        packed = np.sort((docs.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
        new = packed[np.append(True, packed[1:] != packed[:-1])] if len(packed) else packed
        return np.bincount((new >> np.uint64(44)).astype(np.int64), minlength=n_docs)

    three = same_doc(doc, 3)
    n_three = np.bincount(doc[: len(three)][three], minlength=n_docs)
    new_three = distinct(doc[: len(three)][three], chain(h, 3)[three])
    pairs = same_doc(doc, 2)
    again = np.bincount(doc[:-1][pairs & (h[1:] == h[:-1])], minlength=n_docs) if len(h) > 1 else n_words * 0
    shares = np.stack(
        [
            size * per_word, (distinct(doc, h) * per_word) * np.log1p(n_words),
            (n_three - new_three) / np.maximum(n_three, 1), again * per_word, upper / np.maximum(upper + lower, 1),
            digits * per_word, symbols * per_word, stops * per_word, bars * per_word, marks * per_word, lines * per_word,
        ],
        axis=1,
    )
    return np.concatenate([np.log1p(n_words)[:, None], shares, np.sqrt(shares)], axis=1)


class Ranking:
    """A learned score: weights on standardised features, and the score at the chosen quantile."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, cut: float):
        self.mean, self.scale, self.weights, self.cut = mean, scale, weights, cut

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; ``THRESHOLD`` at the cut."""
        at = self.raw(x) - self.cut + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(at, -35, 35)))


def learn(x: np.ndarray, good: np.ndarray) -> Ranking:
    """Bradley-Terry weights by Newton steps on pairs dealt evenly between good and bad documents."""
    width = x.shape[1]
    mean = x.mean(0) if len(x) else np.zeros(width)
    scale = np.maximum(x.std(0), 1e-6) if len(x) else np.ones(width)
    flat = Ranking(mean, scale, np.zeros(width), 0.0)
    wins, losses = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    if not len(wins) or not len(losses):
        return flat
    random = np.random.default_rng(3)
    n = min(MAX_PAIRS, len(wins) * len(losses))
    a = np.resize(random.permutation(wins), n)
    b = np.resize(random.permutation(losses), n)
    b = b[random.permutation(n)]
    z = np.clip((x - mean) / scale, -8, 8)
    d = z[a] - z[b]
    w = np.zeros(width)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(np.clip(d @ w, -35, 35)))
        slope = d.T @ p / n - L2 * w
        bend = (d * (p * (1 - p))[:, None]).T @ d / n + L2 * np.eye(width)
        step = np.linalg.solve(bend, slope)
        w += step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    raw = z @ w
    # The quantile that the labels agree with best; of several, the middle one.
    order = np.argsort(raw, kind="stable")
    right = np.cumsum(np.append(0, np.where(good[order] == 0, 1, -1)))
    best = np.flatnonzero(right == right.max())
    k = int(best[len(best) // 2])
    edge = np.concatenate([[raw.min() - 1], raw[order], [raw.max() + 1]])
    return Ranking(mean, scale, w, float((edge[k] + edge[k + 1]) / 2))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = FIT_ROWS) -> Ranking:
    """Learns from at most ``limit`` labelled training documents; their features reach the driver.

    With labels of one kind only, or none, every score is ``THRESHOLD``.
    """
    sample = training_sample(docs, labels, label, limit).select("doc_id", "text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [list(r) for part in slices(batch.column(1)) for r in features(part)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    found = sample.mapInArrow(run, "doc_id long, label int, x array<double>").toPandas()
    found = found.sort_values("doc_id", kind="stable")
    width = 1 + 2 * 11
    x = np.stack(found.x.to_list()) if len(found) else np.empty((0, width))
    return learn(x, found.label.to_numpy())


def score(docs: DataFrame, ranking: Ranking, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, higher for better texts.

    - Null and empty texts have zero features and are scored like any other.
    - Repeated rows and ties score alike. Whole texts count, whatever their length.
    - A column named ``score`` is replaced, other columns pass through; an empty
      table gives an empty result.
    """
    kept = [c for c in docs.columns if c != "score"]
    rows = docs.select(*[f"`{c}`" for c in kept])
    schema = StructType([*rows.schema.fields]).add("score", "double")
    place = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0), *[ranking.score(features(part)) for part in slices(batch.column(place))]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found))], names=[*kept, "score"])

    return rows.mapInArrow(run, schema)
