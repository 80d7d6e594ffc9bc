"""N-gram Jaccard join with prefix trees.

Documents are sets of hashed word n-grams in one global order, rare ones first. Two
sets whose Jaccard similarity reaches the threshold share one of their first
few n-grams, so documents meet by those: all that share one form a block,
named after the shortest set among them, and blocks of the same name merge. A block
keeps its sets in a trie. A set walks down the trie, sharing the overlap counted
so far between all sets below a node, and leaves a subtree as soon as the
n-grams that remain on either side cannot reach the overlap it needs. Blocks are
worked twice: with the first n-grams alone, whose bound rules nearly all strangers
out, and what is left with whole sets.

- Equal sets are one class before any of this, so a group of copies is one set.
- Links between sets that a block already connects are not looked for again: what
  leaves a block is a spanning forest of its links, never all pairs.
- Very frequent n-grams come last in the order, known by a table of bucket counts
  over the whole corpus with a fixed size, so boilerplate starts no block.
- In a block of more than two chunks of ``CHUNK`` sets, all chunks first meet one
  chunk; then only sets outside the largest connected part meet the others.
- Components are found by joins; nothing per document reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.llm.bytesview import Slice, chain, mix, same_doc, slices, words
from tallyferry.llm.components import components
from tallyferry.session import materialise

WORDS = 5
PERCENT = 80
BUCKETS = 1 << 18
CHUNK = 2000
_TAG = np.uint64(0xA24BAED4963EE407)
#: A word, for Spark's regular expressions.
_WORD = r"[^\x20\x09-\x0D]"


def shingles(part: Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of every word n-gram of a slice, repeats included.

    A document with fewer words than ``size`` has its whole word sequence as one.
    """
    found = words(part, lower=True)
    mask = same_doc(found.doc, size)
    docs, hashes = [found.doc[: len(mask)][mask]], [chain(found.hashes, size)[mask]]
    counts = np.bincount(found.doc, minlength=len(part.starts))
    firsts = np.cumsum(counts) - counts
    for few in range(1, size):
        own = np.flatnonzero(counts == few)
        if len(own):
            docs.append(own)
            hashes.append(mix(chain(found.hashes, few)[firsts[own]] + np.uint64(int(_TAG) * few % (1 << 64))))
    return np.concatenate(docs), np.concatenate(hashes) >> np.uint64(6)


def token_sets(part: Slice, size: int, rank: np.ndarray) -> Iterator[np.ndarray]:
    """Each document's set as sorted numbers: the rank of the n-gram's bucket, then its hash."""
    doc, hashes = shingles(part, size)
    token = (rank[(hashes & np.uint64(BUCKETS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(58)) | hashes
    order = np.argsort(doc, kind="stable")
    cuts = np.searchsorted(doc[order], np.arange(len(part.starts) + 1))
    token = token[order]
    for a, b in zip(cuts[:-1], cuts[1:]):
        own = np.sort(token[a:b])
        if b - a > 1:
            own = own[np.append(True, own[1:] != own[:-1])]
        yield own


def bucket_ranks(rows: DataFrame, size: int) -> np.ndarray:
    """A rank below 64 for each bucket of n-grams; 0 but for buckets far above the mean count.

    Counts every n-gram of the corpus. ``BUCKETS`` numbers reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch.column(0)):
                _, hashes = shingles(part, size)
                counts += np.bincount((hashes & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], names=["bucket", "n"])

    found = rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS)
    for row in found.collect():
        counts[row.bucket] = row.n
    usual = np.median(counts)
    above = counts - usual - 6 * np.sqrt(usual) - 8
    return np.where(above > 0, np.clip(np.floor(np.log2(np.maximum(counts, 1))), 1, 63), 0).astype(np.uint8)


class _Node:
    __slots__ = ("run", "depth", "least", "most", "below", "ends", "one")

    def __init__(self, run: np.ndarray, depth: int):
        self.run, self.depth = run, depth
        self.least, self.most = 1 << 60, 0
        self.below: dict[int, _Node] = {}
        self.ends: list[tuple[int, int]] = []
        #: A set that all sets below are connected with; -1 if there are several parts.
        self.one: int | None = None


class Trie:
    """Sets, or their first n-grams, as paths of local numbers; runs without a fork are one node.

    ``top`` names the connected part of a set, as far as it is known.
    """

    def __init__(self, size: int, percent: int, top: Callable[[int], int]):
        self._top = top
        self._inside = np.zeros(size, bool)
        self._percent = percent
        self._root = _Node(np.empty(0, np.int64), 0)

    def add(self, who: int, path: np.ndarray, n: int) -> None:
        """Stores a set of ``n`` n-grams of which ``path`` are the first."""
        node, at = self._root, 0
        while True:
            node.least, node.most = min(node.least, n), max(node.most, n)
            if node.one is None:
                node.one = who
            elif node.one >= 0 and self._top(node.one) != self._top(who):
                node.one = -1
            if at == len(path):
                node.ends.append((who, n))
                return
            below = node.below.get(int(path[at]))
            if below is None:
                leaf = _Node(path[at:], len(path))
                leaf.least = leaf.most = n
                leaf.one = who
                leaf.ends.append((who, n))
                node.below[int(path[at])] = leaf
                return
            run = below.run
            most = min(len(run), len(path) - at)
            unlike = np.flatnonzero(run[:most] != path[at : at + most])
            same = int(unlike[0]) if len(unlike) else most
            if same < len(run):
                fork = _Node(run[:same], below.depth - len(run) + same)
                fork.least, fork.most, fork.one = below.least, below.most, below.one
                fork.below[int(run[same])] = below
                below.run = run[same:]
                node.below[int(path[at])] = fork
                below = fork
            node, at = below, at + same

    def partners(self, path: np.ndarray, n: int, skip) -> Iterator[int]:
        """Stored sets whose overlap with a set of ``n`` can reach the threshold, but those that ``skip`` names.

        ``path`` are the set's first n-grams. When both paths are whole sets the
        bound is the overlap itself and the answer exact.
        """
        percent, inside, last = self._percent, self._inside, path[-1]
        inside[path] = True
        # Overlap so far, and how many n-grams of the stored sets were compared.
        stack = [(self._root, 0, 0)]
        while stack:
            node, overlap, seen = stack.pop()
            if 100 * node.most < percent * n or 100 * n < percent * node.least:
                continue
            # What is connected already is left out, by whole subtrees.
            if node.one is not None and node.one >= 0 and skip(node.one):
                continue
            left = n
            if len(node.run):
                overlap += int(np.count_nonzero(inside[node.run]))
                if seen == node.depth - len(node.run):
                    seen += int(np.searchsorted(node.run, last, side="right"))
                left -= int(np.searchsorted(path, node.run[-1], side="right"))
                if (100 + percent) * (overlap + min(left, node.most - seen)) < percent * (n + node.least):
                    continue
            for who, size in node.ends:
                if (100 + percent) * (overlap + min(left, size - seen)) >= percent * (n + size) and not skip(who):
                    yield who
            stack.extend((below, overlap, seen) for below in node.below.values())
        inside[path] = False


def block_links(
    ids: list[int], paths: list[np.ndarray], sizes: list[int], percent: int, parts: list[int] | None = None
) -> list[tuple[int, int]]:
    """A spanning forest of the links, or possible links, in a block; sets of one part count as connected."""
    every, place = np.unique(np.concatenate(paths), return_inverse=True)
    cuts = np.cumsum([0] + [len(s) for s in paths])
    firsts: dict[int, int] = {}
    parent = [firsts.setdefault(part, k) for k, part in enumerate(parts)] if parts else list(range(len(ids)))

    def top(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    trie = Trie(len(every), percent, top)
    out = []
    for k, n in enumerate(sizes):
        path = place[cuts[k] : cuts[k + 1]]
        for other in trie.partners(path, n, lambda o, k=k: top(o) == top(k)):
            parent[top(k)] = top(other)
            out.append((ids[k], ids[other]))
        trie.add(k, path, n)
    return out


def clusters(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(smallest id, other id) for the groups that links form."""
    parent = {i: i for pair in links for i in pair}

    def top(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return [(top(i), i) for i in parent if top(i) != i]


def _meetings(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (token, n, rep), sorted: (block, rep) for every token that several sets share.

    A block is named after its first set. Sets of one token whose sizes are too far apart
    to link are parted. One batch is held at a time, however many sets share a token.
    """
    last = None
    for batch in batches:
        token, n, rep = (batch.column(i).to_numpy() for i in range(3))
        if not len(token):
            continue
        new = np.append(True, (token[1:] != token[:-1]) | (percent * n[1:] > 100 * n[:-1]))
        if last is not None and last[0] == token[0] and percent * n[0] <= 100 * last[1]:
            new[0] = False
        run = np.cumsum(new)
        # The block that the batch before left open goes on as run 0.
        names = np.append(last[2] if last is not None else -1, rep[new])
        # A first set is named when the second comes, so sets alone give no row.
        later = ~new
        block = names[run[later]]
        pairs = np.concatenate([np.stack([block, block]), np.stack([block, rep[later]])], axis=1)
        last = (token[-1], n[-1], names[-1])
        pairs = np.unique(pairs, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["block", "rep"])


#: What tells rows apart, in the order in which the first of several is chosen; never null.
_KEY = ["no_id", "id", "h", "c"]


def _key_columns(id_col: str, text_col: str) -> list[Column]:
    """Whether there is an id, the id, and two hashes of the text: rows alike in these are copies of one row."""
    doc_id, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    return [doc_id.isNull(), F.coalesce(doc_id, F.lit(0)), F.xxhash64(text), F.coalesce(F.crc32(text.cast("binary")), F.lit(0))]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The text and the row's key."""
    key = [k.alias(name) for k, name in zip(_key_columns(id_col, text_col), _KEY)]
    return docs.select(F.col(f"`{text_col}`").alias("text"), *key)


def _classes(rows: DataFrame, size: int, percent: int, nameless: bool) -> tuple[DataFrame, DataFrame]:
    """Each row of ``_keyed`` with its set's size and digests; each set's digests with the first key of its component.

    Without ``nameless``, rows without an id belong to no set.
    """
    rank = bucket_ranks(rows, size)

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, d1, d2, prefix = [], [], [], []
            for part in slices(batch.column(0)):
                for own in token_sets(part, size, rank):
                    k = len(own)
                    n.append(k)
                    d1.append(mix(own).sum(dtype=np.uint64))
                    d2.append(mix(own ^ _TAG).sum(dtype=np.uint64))
                    prefix.append(own[: k - -(-percent * k // 100) + 1].view(np.int64) if k else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(1, 5)], pa.array(n, pa.int64()),
                    pa.array(np.array(d1, np.uint64).view(np.int64)), pa.array(np.array(d2, np.uint64).view(np.int64)),
                    pa.array(prefix, pa.list_(pa.int64())),
                ],
                names=[*_KEY, "n", "d1", "d2", "prefix"],
            )

    schema = "no_id boolean, id long, h long, c long, n long, d1 long, d2 long, prefix array<long>"
    sets = materialise(rows.mapInArrow(to_sets, schema), "sets")
    known = sets.where("n > 0" if nameless else "n > 0 and not no_id")
    # Sets are told apart by a number of their own: one id may stand for several texts.
    reps = known.groupBy("d1", "d2").agg(F.min(F.struct(*_KEY)).alias("first"))
    reps = materialise(reps.withColumn("rep", F.monotonically_increasing_id()), "reps")

    # Documents that share an n-gram of their prefixes meet in blocks.
    firsts = known.join(reps, ["d1", "d2"]).where(F.struct(*_KEY) == F.col("first")).dropDuplicates(["d1", "d2"])
    firsts = materialise(firsts.select("rep", "n", "prefix"), "firsts")
    starts = firsts.select(F.explode_outer("prefix").alias("token"), "n", "rep")
    met = starts.repartition("token").sortWithinPartitions("token", "n", "rep")
    meetings = materialise(met.mapInArrow(lambda b: _meetings(b, percent), "block long, rep long").distinct(), "meetings")

    def by_prefix(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int]]:
        values, cuts = batch.column(6).values.to_numpy().view(np.uint64), batch.column(6).offsets.to_numpy()
        return ((values[a:b], n) for a, b, n in zip(cuts[:-1], cuts[1:], batch.column(5).to_pylist()))

    def by_text(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int]]:
        return ((own, len(own)) for part in slices(batch.column(5)) for own in token_sets(part, size, rank))

    # First by the prefixes alone, which leaves few; then by whole sets, made from the texts again.
    close = materialise(_groups(*_links(meetings, firsts, ["rep"], by_prefix, percent)), "close")
    named = close.join(reps.select("rep", "first.*"), "rep")
    whole, parted = _links(named, rows, _KEY, by_text, percent)
    parts = components((whole if parted is None else whole.union(parted)).select("a", "b"))

    parts = parts.withColumnRenamed("node", "rep").join(reps.select("rep", "first"), "rep")
    heads = parts.groupBy("component").agg(F.min("first").alias("head"))
    heads = parts.select("rep", "component").join(heads, "component").select("rep", "head")
    classes = reps.join(heads, "rep", "left").select("d1", "d2", F.coalesce("head", "first").alias("head"))
    return sets.drop("prefix"), classes


def linked_components(
    docs: DataFrame, size: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest id reachable by links.

    Two documents link when 100 * intersection >= percent * union of their sets of
    ``size``-word shingles, ASCII letters in lower case.

    - Null text, or one without words: an empty set, linked with nothing.
    - Fewer than ``size`` words: the whole sequence is the one shingle.
    - Null id: the row stays with a null component_id and links with nothing.
    - Repeated rows and copies are one class; each row is returned.
    - Rows of one id with different texts are linked each by its own text.
    - An empty table gives an empty result; extra columns are not read.
    """
    sets, classes = _classes(_keyed(docs, id_col, text_col), size, percent, nameless=False)
    n = F.col("n").alias("n_shingles")
    linked = sets.where("not no_id and n > 0").join(classes, ["d1", "d2"])
    linked = linked.select(F.col("id").alias("doc_id"), n, F.col("head.id").alias("component_id"))
    doc_id = F.when(~F.col("no_id"), F.col("id"))
    return linked.union(sets.where("no_id or n = 0").select(doc_id.alias("doc_id"), n, doc_id.alias("component_id")))


def _links(meetings: DataFrame, what: DataFrame, on: list[str], paths, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """Pairs ``block``, ``a``, ``b`` that connect, within each block, the sets that links connect at all.

    First those of blocks that were one job, where ``a`` is the smallest of its group; then those of larger ones, if any.
    ``meetings`` has ``block``, ``rep`` and the columns ``on``, by which ``what`` brings the sets.
    A block of up to two chunks is one job. In a larger one, every chunk first meets one and the
    same chunk; what this connects is not compared again. Then only the sets outside the largest
    connected part meet all others, so a large group of near copies costs its length.
    """

    def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _worked(batches, paths, percent)

    def run(jobs: DataFrame) -> DataFrame:
        others = [c for c in what.columns if c not in on]
        # One plan at every size: sorted merges, which adaptive execution splits where a block is hot.
        dealt = jobs.join(what.hint("merge"), on).repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "rep")
        dealt = dealt.select("block", "i", "j", "rep", "part", *others)
        return materialise(dealt.mapInArrow(worked, "block long, a long, b long"), "found-links")

    keys = [c for c in on if c != "rep"]
    sizes = materialise(meetings.groupBy("block").agg(F.count(F.lit(1)).alias("members")), "blocks")
    one = F.lit(0)
    small = meetings.join(sizes.where(F.col("members") <= 2 * CHUNK), "block")
    found = run(small.select("block", "rep", *keys, one.alias("i"), one.alias("j"), F.col("rep").alias("part")))
    big = sizes.where(F.col("members") > 2 * CHUNK).withColumn("chunks", F.ceil(F.col("members") / CHUNK).cast("int"))
    if big.isEmpty():
        return found, None

    large = meetings.join(big, "block").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    large = materialise(large.withColumn("member", F.monotonically_increasing_id()), "large-blocks")
    star = F.when(F.col("own") == 0, F.sequence(F.lit(1), F.col("chunks") - 1)).otherwise(F.array("own"))
    first = run(large.select("block", "rep", *keys, one.alias("i"), F.explode(star).alias("j"), F.col("rep").alias("part")))

    parts = components(_between_members(large, first))
    parted = large.join(parts.withColumnRenamed("node", "member"), "member", "left")
    parted = materialise(parted.withColumn("part", F.coalesce("component", "member")).drop("component"), "parted")
    counts = parted.groupBy("block", "part").agg(F.count(F.lit(1)).alias("n"))
    most = counts.groupBy("block").agg(F.max_by("part", F.struct("n", "part")).alias("largest"), F.sum("n").alias("all"), F.max("n").alias("n"))
    rest = most.withColumn("out_chunks", F.ceil((F.col("all") - F.col("n")) / CHUNK).cast("int")).where("out_chunks > 0")
    open_ = parted.join(rest.select("block", "largest", "out_chunks"), "block")
    outside = open_.where("part <> largest").withColumn("i", F.pmod(F.xxhash64("rep"), F.col("out_chunks")).cast("int"))
    jobs = outside.withColumn("j", F.explode(F.sequence(one, F.col("chunks") - 1))).unionByName(
        open_.withColumn("i", F.explode(F.sequence(one, F.col("out_chunks") - 1))).withColumn("j", F.col("own"))
    )
    second = run(jobs.select("block", "rep", *keys, "i", "j", "part"))
    return found, first.union(second)


def _between_members(members: DataFrame, links: DataFrame) -> DataFrame:
    """Links of sets as links of the numbers that sets have in their blocks."""
    for end in ("a", "b"):
        of = members.select("block", F.col("rep").alias(end), F.col("member").alias(f"{end}_member"))
        links = links.join(of, ["block", end])
    return links.select(F.col("a_member").alias("a"), F.col("b_member").alias("b"))


def _groups(whole: DataFrame, parted: DataFrame | None) -> DataFrame:
    """``block``, ``rep``: what ``_links`` connects within one block, as blocks named after their smallest set."""
    both = F.explode(F.array("a", "b")).alias("rep")
    groups = whole.select(F.col("a").alias("block"), both)
    if parted is not None:
        there = parted.select("block", both).distinct()
        there = materialise(there.withColumn("member", F.monotonically_increasing_id()), "linked")
        parts = components(_between_members(there, parted))
        parts = there.join(parts.withColumnRenamed("node", "member"), "member").select("component", "rep")
        names = parts.groupBy("component").agg(F.min("rep").alias("block"))
        groups = groups.union(parts.join(names, "component").select("block", "rep"))
    return groups.distinct()


def _worked(batches: Iterator[pa.RecordBatch], members, percent: int) -> Iterator[pa.RecordBatch]:
    """Runs ``block_links`` on each job of sorted rows (block, i, j, rep, part, ...); links are (block, a, b)."""
    key, ids, parts, paths, sizes = None, [], [], [], []
    found: list[tuple[int, int, int]] = []

    def end() -> None:
        if len(ids) > 1:
            found.extend((key[0], a, b) for a, b in clusters(block_links(ids, paths, sizes, percent, parts)))
        ids.clear(), parts.clear(), paths.clear(), sizes.clear()

    def give() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(3)], names=["block", "a", "b"])
        found.clear()
        return out

    for batch in batches:
        keys = zip(*[batch.column(i).to_pylist() for i in range(3)])
        for now, rep, part, (path, n) in zip(keys, batch.column(3).to_pylist(), batch.column(4).to_pylist(), members(batch)):
            if now != key:
                end()
                key = now
            # Repeated rows bring the same set again.
            if n and not (ids and ids[-1] == rep):
                ids.append(rep)
                parts.append(part)
                paths.append(path)
                sizes.append(n)
        yield give()
    end()
    yield give()


def one_per_group(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of every group of linked documents: that of the smallest id.

    - Rows are told apart by id and text. Rows of one id with unlinked texts stay each; of
      rows of the smallest id, one of the text with the smallest hash stays.
    - Rows without an id are compared like others and come after all ids.
    - Rows without words are linked with nothing and stay, repeated ones too.
    - Rows alike in id and text are one document, kept once whatever their other columns.
    - An empty table gives an empty result; columns of any names pass through.
    """
    sets, classes = _classes(_keyed(docs, "doc_id", "text"), size, percent, nameless=True)
    known = sets.where("n > 0").join(classes, ["d1", "d2"])
    gone = known.where(F.struct(*_KEY) != F.col("head")).select(*_KEY).distinct()
    lead = "_"
    while any(c.lower().startswith(lead) for c in docs.columns):
        lead += "_"
    hidden = [lead + name for name in _KEY]
    worded = F.coalesce(F.col("text").rlike(_WORD), F.lit(False))
    marked = docs.where(worded).select("*", *[k.alias(name) for k, name in zip(_key_columns("doc_id", "text"), hidden)])
    # Copies of one row go before rows are shuffled.
    left = marked.dropDuplicates(hidden).join(gone.toDF(*hidden), hidden, "left_anti")
    return left.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where(~worded))
