"""SimHash near-duplicates: fingerprints that differ in few bits, through a Gray-order index.

Equal fingerprints are one class before anything else happens. Classes meet by
bands: of ``distance + 1`` bands of bits, two fingerprints within the distance share
at least one, so each class goes to one group per band and every link is inside
some group. A group larger than a task should hold is cut again by bands of the bits
that its members do not share yet, until it fits; no pair is lost and no group is capped.

Inside a group the fingerprints are in order of their Gray rank, in which neighbours
differ in few bits. The index over that order is a tree: a node's mask holds the bits in
which all its fingerprints agree, its pattern what these bits are, and bits known
higher up are factored out, so a node has only what it adds. The search walks pairs
of nodes from the top and adds up the differences in newly shared bits; a pair over
the distance is dropped with everything below it, and so is a pair of nodes whose
members are linked already. A group yields the links of a spanning star per linked set, not all
pairs.

Shuffles: ids and fingerprints (16 bytes a document) and, per class, one row per band.
Texts are read once and not moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.llm.components import components
from tallyferry.session import materialise

BITS = 64
SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Fingerprints of one group that a task holds (8 bytes each, some 20 times that while it is searched).
GROUP_LIMIT = 1 << 18
#: Wanted size of a group where the number of classes leaves the choice.
GROUP_AIM = 1 << 10
#: Fingerprints that a task gathers, in whole groups, before it searches them.
GATHERED = 1 << 15
#: Tasks over which documents of one fingerprint spread.
SALTS = 32
LEAF = 16
FAN_OUT = 8
#: Node pairs and fingerprint pairs looked at in one step.
STEP_PAIRS = 1 << 12


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = min(SHINGLE, len(words))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    hashed = xxhash.xxh64_intdigest
    hashes = np.array([hashed(joined[a:b], SEED) for a, b in spans], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long, of every row; no shuffle."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "fp"])

    return rows.mapInArrow(work, "doc_id long, fp long")


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def gray_rank(fp: Column) -> Column:
    """Where a fingerprint stands in Gray order, shifted so that signed longs sort by it."""
    rank = fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


class Forest:
    """Trees over sorted fingerprints, one per group: masks and patterns of runs of neighbours.

    ``levels[0]`` are the leaves. Per level: first and end of each node among the nodes (or
    fingerprints) below, ``known``: the bits in which all below agree, ``pattern``: their values.
    """

    def __init__(self, values: np.ndarray, bounds: np.ndarray):
        self.values = values
        self.levels: list[dict[str, np.ndarray]] = []
        below_and, below_or, size = values, values, LEAF
        while True:
            first, end, bounds = _runs_in(bounds, size)
            all_and = np.bitwise_and.reduceat(below_and, first)
            all_or = np.bitwise_or.reduceat(below_or, first)
            self.levels.append({"first": first, "end": end, "known": ~(all_and ^ all_or), "pattern": all_and})
            if (np.diff(bounds) == 1).all():
                break
            below_and, below_or, size = all_and, all_or, FAN_OUT

    def spread(self, of_values: np.ndarray) -> list[np.ndarray]:
        """Per level, the value that all members of a node have; -1 where they differ."""
        out, below = [], of_values
        for level in self.levels:
            low = np.minimum.reduceat(below, level["first"])
            high = np.maximum.reduceat(below, level["first"])
            low = np.where(low == high, low, -1)
            out.append(low)
            below = low
        return out


def _runs_in(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of at most ``size`` inside each group: first, end, and the groups' bounds among the runs."""
    counts = -(-np.diff(bounds) // size)
    groups = np.concatenate([[0], np.cumsum(counts)])
    group = np.repeat(np.arange(len(counts)), counts)
    first = bounds[group] + (np.arange(groups[-1]) - groups[group]) * size
    end = np.minimum(first + size, bounds[group + 1])
    return first, end, groups


def _products(a_first, a_end, b_first, b_end) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of members of the k-th ranges, with k."""
    wide, high = b_end - b_first, a_end - a_first
    counts = wide * high
    k = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(k)) - np.repeat(np.cumsum(counts) - counts, counts)
    return k, a_first[k] + within // wide[k], b_first[k] + within % wide[k]


def linked_sets(values: np.ndarray, bounds: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """For each fingerprint the position of its linked set's first member, by group.

    ``values``: different fingerprints in Gray order inside each group ``bounds[g]`` to
    ``bounds[g + 1]``. Memory follows ``STEP_PAIRS`` and the groups' size.
    """
    label = np.arange(len(values))
    if not len(values):
        return label
    forest = Forest(values, bounds)
    top = len(forest.levels) - 1
    roots = np.arange(len(forest.levels[top]["first"]))
    nothing = np.zeros(len(roots), np.uint64)
    # Last in, first out: pairs near the leaves are settled before others are opened.
    waiting = [(top, roots, roots, np.zeros(len(roots), np.int64), nothing)]
    shared_label = forest.spread(label)
    while waiting:
        depth, a, b, differ, common = waiting.pop()
        if len(a) > STEP_PAIRS:
            # The latter half waits below, so the beginning of the order is settled first.
            for cut in (slice(len(a) // 2, None), slice(0, len(a) // 2)):
                waiting.append((depth, a[cut], b[cut], differ[cut], common[cut]))
            continue
        level = forest.levels[depth]
        same = (shared_label[depth][a] >= 0) & (shared_label[depth][a] == shared_label[depth][b])
        fresh = level["known"][a] & level["known"][b] & ~common
        differ = differ + np.bitwise_count((level["pattern"][a] ^ level["pattern"][b]) & fresh)
        open_ = ~same & (differ <= distance)
        a, b, differ, common = a[open_], b[open_], differ[open_], (common | fresh)[open_]
        if not len(a):
            continue
        k, left, right = _products(level["first"][a], level["end"][a], level["first"][b], level["end"][b])
        if depth == 0:
            near = (left < right) & (label[left] != label[right])
            left, right = left[near], right[near]
            near = np.bitwise_count(values[left] ^ values[right]) <= distance
            if near.any():
                label = _united(label, label[left[near]], label[right[near]])
                shared_label = forest.spread(label)
        else:
            ahead = left <= right
            k, left, right = k[ahead], left[ahead], right[ahead]
            # Neighbours first: once linked, they spare the search between their nodes.
            order = np.argsort(right - left, kind="stable")
            waiting.append((depth - 1, left[order], right[order], differ[k][order], common[k][order]))
    return label


def _united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after uniting the sets ``a[k]`` and ``b[k]``; the smaller label stays."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    pairs = np.unique(np.stack([high, low], axis=1), axis=0)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    for x, y in pairs.tolist():
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    moved = np.arange(len(label))
    for x in parent:
        moved[x] = root(x)
    return moved[label]


def _cut(bits: list[int], pieces: int) -> list[list[int]]:
    """The bits in ``pieces`` bands of nearly the same width."""
    return [bits[len(bits) * i // pieces : len(bits) * (i + 1) // pieces] for i in range(pieces)]


def _narrower(masks: list[int], pieces: int) -> list[int]:
    """For each mask those with one more band of the bits that it does not hold."""
    out = []
    for mask in masks:
        free = [bit for bit in range(BITS) if not mask >> bit & 1]
        out += [mask | sum(1 << bit for bit in band) for band in _cut(free, pieces)]
    return out


def links(classes: DataFrame, distance: int = DISTANCE, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Pairs ``a``, ``b`` of fingerprints that connect all within ``distance`` of each other.

    ``classes`` has a column ``fp`` of different longs. The pairs are a spanning star of
    each linked set of a group, so their ends may be more than ``distance`` apart.
    """
    pieces = distance + 1
    total = classes.count()
    # Short keys while there are few classes: fewer groups, which the index cuts better.
    width = max(1, min(BITS // pieces, (total // GROUP_AIM).bit_length()))
    masks = [sum(1 << bit for bit in band[:width]) for band in _cut(list(range(BITS)), pieces)]
    members = classes.select("fp", F.lit(0).alias("path"))
    found = []
    while True:
        table = F.array(*[F.lit(m - (m >> 63 << 64)).cast("long") for m in masks])
        children = F.explode(F.array(*[F.col("path") * pieces + i for i in range(pieces)])).alias("path")
        dealt = members.select("fp", children).withColumn("shared", F.col("fp").bitwiseAND(F.get(table, F.col("path"))))
        if total <= group_limit:
            found.append(_searched(dealt, distance))
            break
        dealt = materialise(dealt, "bands")
        sizes = dealt.groupBy("path", "shared").agg(F.count(F.lit(1)).alias("n"))
        large = materialise(sizes.where(F.col("n") > group_limit).select("path", "shared"), "large-bands")
        found.append(_searched(dealt.join(large, ["path", "shared"], "left_anti"), distance))
        members = dealt.join(large, ["path", "shared"], "left_semi").select("fp", "path")
        if large.isEmpty():
            break
        masks = _narrower(masks, pieces)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


def _searched(dealt: DataFrame, distance: int) -> DataFrame:
    """The links inside every group (path, shared)."""
    ordered = (
        dealt.withColumn("rank", gray_rank(F.col("fp"))).repartition("path", "shared")
        .sortWithinPartitions("path", "shared", "rank").select("path", "shared", "fp")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((3, 0), np.int64)
        for batch in batches:
            now = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            held = np.concatenate([held, now], axis=1)
            starts = _group_starts(held)
            # The last group may go on in the next batch.
            if len(starts) > 1 and starts[-1] >= GATHERED:
                yield _stars(held[:, : starts[-1]], distance)
                held = held[:, starts[-1] :]
        yield _stars(held, distance)

    return ordered.mapInArrow(work, "a long, b long")


def _group_starts(held: np.ndarray) -> np.ndarray:
    if not held.shape[1]:
        return np.empty(0, np.int64)
    return np.concatenate([[0], 1 + np.flatnonzero((held[:2, 1:] != held[:2, :-1]).any(axis=0))])


def _stars(held: np.ndarray, distance: int) -> pa.RecordBatch:
    values = np.ascontiguousarray(held[2])
    label = linked_sets(values.view(np.uint64), np.append(_group_starts(held), len(values)), distance)
    ends = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([pa.array(values[label[ends]]), pa.array(values[ends])], names=["a", "b"])


def _salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int").alias("salt")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, group_limit: int = GROUP_LIMIT
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every row: the least id reachable over links, its own included.

    Two rows link when their fingerprints differ in at most ``distance`` bits.

    - Null, empty or blank text: fingerprint zero, linked like any other.
    - Null id: it links rows like any other and is never a component_id, unless the
      whole component has no id; then component_id is null.
    - Rows with the same id are rows of their own; equal texts have equal fingerprints.
    - An empty table gives no rows. Extra columns are not read, whatever their names.
    """
    prints = materialise(fingerprints(docs, id_col, text_col), "simhashes")
    salted = prints.select("doc_id", "fp", _salt("doc_id"))
    parts = salted.groupBy("fp", "salt").agg(F.min("doc_id").alias("first_id"))
    classes = materialise(parts.groupBy("fp").agg(F.min("first_id").alias("first_id")), "simhash-classes")
    linked = materialise(
        components(links(classes, distance, group_limit)).select(F.col("node").alias("fp"), "component", _salt("node")), "linked"
    )
    least = linked.join(classes, "fp").groupBy("component").agg(F.min("first_id").alias("least_id"))
    # One row per component and salt: a component of many classes is joined by many tasks.
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = linked.join(least, ["component", "salt"]).select("fp", "least_id")
    of_class = classes.join(named, "fp", "left").select("fp", F.coalesce("least_id", "first_id").alias("component_id"))
    return salted.join(parts.select("fp", "salt").join(of_class, "fp"), ["fp", "salt"]).select("doc_id", "fp", "component_id")
