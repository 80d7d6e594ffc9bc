"""Mixing sources to target weights with a splitting tree.

Every source is permuted by a hash of ids and texts (equal rows are told apart by a
number) and cut into blocks. Target weights become
exact block quotas per source. A binary tree over the output shards splits the
quota vector by multivariate hypergeometric draws, so each shard gets its own
exact quotas; shards then own disjoint runs of the permuted blocks and order
their documents locally by a hash.

Only per-source figures reach the driver, of at most ``MAX_SOURCES`` sources. Finding a document's shard is an
expression on its own row plus one row per source, so the corpus moves once, to
its shards. A hot source only has more rows per block; nothing is gathered by
source but sums.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyferry.session import materialise

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_REPEATS = 2
BLOCK_DOCS = 256
MAX_BLOCKS = 4096
#: Shards of a small mix; a larger one has one for so many words, and blocks enough for each.
SHARDS = 16
WORDS_PER_SHARD = 1 << 24
BLOCKS_PER_SHARD = 8
#: More different sources than this are taken for a wrong column.
MAX_SOURCES = 1_000_000
#: Orders tried for the one block per source that is taken in part.
TRIES = 32
#: Units listed in the broadcast table at most; beyond it the sources are joined by shuffle.
BROADCAST_UNITS = 4_000_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(total: float, weights: Sequence[float], limits: Sequence[float]) -> list[float]:
    """Shares of ``total`` by weight, none above its limit, the excess going to the others by weight."""
    limits = np.asarray(limits, float)
    weights = np.asarray(weights, float)
    out = np.zeros(len(limits))
    open_ = limits > 0
    left = min(total, float(limits.sum()))
    while open_.any():
        share = np.where(open_, left * weights / weights[open_].sum(), 0)
        full = open_ & (share >= limits)
        if not full.any():
            out[open_] = share[open_]
            break
        out[full] = limits[full]
        left -= float(limits[full].sum())
        open_ &= ~full
    return out.tolist()


def split_quotas(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Quotas of every shard (rows) per source (columns); columns add up to ``quotas``.

    A node of the tree covers a run of shards. Its left half draws its share of
    the node's blocks without replacement, the right half takes the rest. The
    generator depends on the seed and the node alone, so reruns agree.
    """
    out = np.zeros((shards, len(quotas)), np.int64)

    def descend(first: int, last: int, have: np.ndarray) -> None:
        if last - first == 1:
            out[first] = have
            return
        middle = (first + last) // 2
        draw = int(have.sum()) * (middle - first) // (last - first)
        random = np.random.default_rng([seed, first, last])
        # The marginals method needs memory for the sources only, whatever the quotas are.
        left = random.multivariate_hypergeometric(have, draw, method="marginals")
        descend(first, middle, left)
        descend(middle, last, have - left)

    descend(0, shards, np.asarray(quotas, np.int64))
    return out


def _unit_shards(quotas: np.ndarray, source: int, seed: int) -> list[int]:
    """The shard of each block unit of a source: its units in permuted order, cut by the shards' quotas."""
    counts = quotas[:, source]
    shard = np.repeat(np.arange(len(counts)), counts)
    out = np.empty(len(shard), np.int64)
    out[np.random.default_rng([seed, source, 7]).permutation(len(shard))] = shard
    return out.tolist()


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    shards: int | None = None,
    seed: int = 17,
) -> DataFrame:
    """``docs`` as a struct ``row`` with ``size``, ``source_size``, ``target`` and ``draws``.

    ``draws`` lists copy, unit (the source's block, counted on for the second copy) and shard
    for every time the mix takes the
    document: none, once or twice. The number of shards goes by the size of the mix, if it
    is not given. Sources by code point, null last, weigh
    ``weights`` in turn and share ``share`` times all words; no target is above
    ``MAX_REPEATS`` times its source's words.

    - Null or empty text: size 0. Null source: a source of its own, the last.
    - Null id or repeated id: rows are placed by id and text, so each is drawn for itself; equal
      rows by a number within their group too. Which of these is drawn is not defined.
    - A source without words has target 0; its documents follow its blocks and add no words.
    - Empty input: an empty result. Extra columns stay inside ``row``.
    - More than ``MAX_SOURCES`` sources: an error.
    """
    return _plan(docs, id_col, text_col, source_col, weights, share, shards, seed)[0]


def _plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS,
    share: float = SHARE, shards: int | None = None, seed: int = 17,
) -> tuple[DataFrame, int]:
    """What ``plan_mix`` gives, and the number of shards."""
    spark = docs.sparkSession
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{source_col}`").alias("source"),
        F.xxhash64(*[F.col(f"`{c}`") for c in (source_col, id_col, text_col)]).alias("key"),
        word_count(F.col(f"`{text_col}`")).alias("size"),
    )
    rows = _told_apart(rows)
    # 4096 fine blocks per source, whatever its size; summed next to the scan.
    fine = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(MAX_BLOCKS)).cast("int")
    sums = (
        rows.select("source", fine.alias("fine"), "size")
        .groupBy("source", "fine")
        .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"))
    )
    per_source = (
        sums.groupBy("source").agg(F.sum("words").alias("words"), F.sum("docs").alias("docs"))
        .limit(MAX_SOURCES + 1).collect()
    )
    if len(per_source) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources in {source_col}")
    # Code points sort as UTF-8 bytes do.
    per_source.sort(key=lambda r: (r.source is None, (r.source or "").encode()))
    sizes = [r.words for r in per_source]
    given = [weights[i % len(weights)] for i in range(len(sizes))]
    targets = water_fill(share * sum(sizes), given, [MAX_REPEATS * s for s in sizes])
    n_blocks = [min(MAX_BLOCKS, 1 << max(0, (-(-r.docs // BLOCK_DOCS) - 1).bit_length())) for r in per_source]
    table = spark.createDataFrame(
        [(r.source, s, t, n) for r, s, t, n in zip(per_source, sizes, targets, n_blocks)],
        "source string, source_size long, target double, n_blocks int",
    )

    blocks = _with_source(sums, table, len(per_source) <= BROADCAST_UNITS)
    coarse = blocks.groupBy("source", F.pmod("fine", "n_blocks").alias("block")).agg(
        F.sum("words").alias("words"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"), F.first("n_blocks").alias("n_blocks"),
    )
    in_order = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    rest = F.expr("target - least(floor(target / greatest(source_size, 1)), 1) * source_size")
    reached = (
        coarse.withColumn("upto", F.sum("words").over(in_order))
        .withColumn("rest", rest)
        .groupBy("source")
        .agg(
            # The number of the block where the words end: blocks may be missing.
            F.min(F.when(F.col("upto") > F.col("rest"), F.col("block"))).alias("edge"),
            F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))).alias("done"),
            F.first("rest").alias("rest"),
            F.first("target").alias("target"),
            F.first("source_size").alias("source_size"),
            F.first("n_blocks").alias("n_blocks"),
        )
        .select(
            "source", "n_blocks", "target", "source_size",
            (F.coalesce("edge", "n_blocks") + F.expr("least(floor(target / greatest(source_size, 1)), 1) * n_blocks")).cast("int").alias("whole_units"),
            (F.col("rest") - F.coalesce("done", F.lit(0))).alias("rest"),
        )
        .collect()
    )
    known = spark.createDataFrame(
        [(r.source, r.n_blocks, r.whole_units, float(r.rest)) for r in reached],
        "source string, n_blocks int, whole_units int, rest double",
    )
    # The block where a source's words end is cut between documents, in the best of some orders.
    edge = (
        _with_source(rows.select("source", "key", "size", fine.alias("fine")), known, len(reached) <= BROADCAST_UNITS)
        .where("fine % n_blocks = whole_units % n_blocks and whole_units < 2 * n_blocks")
        .select("source", "rest", "size", "key", F.explode(F.sequence(F.lit(0), F.lit(TRIES - 1))).alias("turn"))
        .withColumn("place", _place("key", "turn", seed))
    )
    by_place = Window.partitionBy("source", "turn").orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    cuts = (
        edge.withColumn("upto", F.sum("size").over(by_place))
        .groupBy("source")
        .agg(
            F.min(F.struct(F.abs(F.col("upto") - F.col("rest")).alias("off"), "turn", "place")).alias("best"),
            F.first("rest").alias("rest"),
        )
        .where("best.off < rest")
        .select("source", "best.turn", "best.place")
        .collect()
    )
    cut = {r.source: (r.turn, r.place) for r in cuts}
    by_source = {r.source: r for r in reached}
    order = [r.source for r in per_source]
    units = [by_source[s].whole_units + (s in cut) for s in order]
    if shards is None:
        shards = max(SHARDS, min(int(sum(targets)) // WORDS_PER_SHARD + 1, sum(units) // BLOCKS_PER_SHARD))
    quotas = split_quotas(units, shards, seed) if order else np.zeros((shards, 0), np.int64)
    final = spark.createDataFrame(
        [
            (s, sizes[i], targets[i], n_blocks[i], by_source[s].whole_units, *cut.get(s, (None, None)),
             _unit_shards(quotas, i, seed))
            for i, s in enumerate(order)
        ],
        "source string, source_size long, target double, n_blocks int, whole_units int, turn int, place long, shard_of array<int>",
    )
    drawn = _with_source(rows, final, sum(units) <= BROADCAST_UNITS)
    block = F.pmod(fine, F.col("n_blocks"))

    def taken(copy: int) -> Column:
        unit = block + copy * F.col("n_blocks")
        whole = unit < F.col("whole_units")
        part = (unit == F.col("whole_units")) & F.col("turn").isNotNull() & (_place("key", "turn", seed) <= F.col("place"))
        pair = F.struct(F.lit(copy).alias("copy"), unit.alias("unit"), F.get("shard_of", unit).alias("shard"))
        return F.when(F.coalesce(whole | part, F.lit(False)), pair)

    return drawn.select(
        "row", "key", "size", "source_size", "target",
        F.filter(F.array(*[taken(c) for c in range(MAX_REPEATS)]), lambda x: x.isNotNull()).alias("draws"),
    ), shards


def _told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` with another ``key`` for each row of equal ones.

    Only the keys are counted; where none repeats, that is all. Else the repeated rows are
    numbered inside the tasks that read them, tasks after one another, and all rows are
    written once, so that every later pass sees the same keys.
    """
    repeated = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    repeated = materialise(repeated, "mix-repeated")
    many = repeated.count()
    if not many:
        return rows
    small = many <= BROADCAST_UNITS
    marks = repeated.select(F.col("key").alias("key_"), F.lit(True).alias("again"))
    # The reading task and the place in it, written so that they stay.
    marked = rows.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    marked = marked.join(F.broadcast(marks) if small else marks, F.expr("key = key_"), "left").drop("key_")
    marked = materialise(marked, "mix-marked")
    again = marked.where("again")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        again.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
        .select("key", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    within = F.row_number().over(Window.partitionBy("key", "part").orderBy("at"))
    numbered = again.withColumn("number", within).join(offsets, ["key", "part"])
    numbered = numbered.withColumn("key", F.xxhash64("key", F.col("offset") + F.col("number")))
    return marked.where("again is null").select(*rows.columns).union(materialise(numbered.select(*rows.columns), "mix-numbered"))


def _place(key: str, turn: str, seed: int) -> Column:
    """A document's place in the ``turn``-th order of its block."""
    return F.xxhash64(key, turn, F.lit(seed + 1))


def _with_source(rows: DataFrame, table: DataFrame, small: bool) -> DataFrame:
    """Rows with the figures of their source, null being a source."""
    there = table.withColumnRenamed("source", "source_")
    return rows.join(F.broadcast(there) if small else there, F.expr("source <=> source_")).drop("source_")


def mix(docs: DataFrame, shards: int | None = None, seed: int = 17, **options) -> DataFrame:
    """The mixed corpus: columns of ``docs``, once for each time a document is drawn.

    Partition k is shard k, in the shard's local random order. See ``plan_mix``
    for the defined cases; columns of ``docs`` named ``shard`` stay as they are.
    """
    plan, shards = _plan(docs, shards=shards, seed=seed, **options)
    drawn = (
        plan.select("row", "key", F.explode("draws").alias("draw"))
        .select("row", F.col("draw.shard").alias("_shard"), F.xxhash64("key", "draw.copy", F.lit(seed + 2)).alias("_at"))
    )
    placed = drawn.repartitionById(shards, F.col("_shard").cast("int")).sortWithinPartitions("_shard", "_at")
    return placed.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
