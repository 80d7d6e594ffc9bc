"""Cutting a table into key ranges of a wanted number of rows.

Ranges are lossless: the first has an open lower end, the last an open upper
end, and rows without a key form chunk -1.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyferry.functions.scalars import ordinal
from tallyferry.operators.intervals import CASE_CUTS, constant_array, halving_case, search_cuts
from tallyferry.operators.ranks import keys_at_multiples
from tallyferry.session import estimated_bytes
from tallyferry.specs import Settings

NULL_CHUNK = -1
# One output folder per chunk: a plan beyond this is a mistake in the chunk size.
MAX_CHUNKS = 1_000_000
# More shuffle tasks than this cost more than they spread.
MAX_TASKS = 100_000
# Stored size that one writing task gets at most, if chunks are no larger.
TASK_MB = 16
_CASE_CUTS = CASE_CUTS


def chunk_boundaries(df: DataFrame, key: str, chunk_rows: int) -> DataFrame:
    """One row per range: ``chunk_id``, the row number its boundary came from,
    ``low_key`` (inclusive, NULL = open) and ``high_key`` (exclusive, NULL = open).

    The boundary keys are those of each ``chunk_rows``-th row in key order; k
    boundaries give k ranges, the last one open, and none gives one open range.
    """
    cuts, total = keys_at_multiples(df, key, chunk_rows)
    ranges = total // chunk_rows
    dtype = df.schema[key].dataType
    if ranges == 0:
        return df.sparkSession.range(1).select(
            F.lit(0).alias("chunk_id"),
            F.lit(total).cast("bigint").alias("row_num"),
            F.lit(None).cast(dtype).alias("low_key"),
            F.lit(None).cast(dtype).alias("high_key"),
        )
    cuts = cuts.select((F.col("row_num") / chunk_rows - 1).cast("int").alias("chunk_id"), "row_num", "cut")
    # Neighbours are met by a join on their number: no window over all cuts in one task.
    previous = cuts.select((F.col("chunk_id") + 1).alias("chunk_id"), F.col("cut").alias("low_key"))
    high = F.when(F.col("chunk_id") < ranges - 1, F.col("cut"))
    return cuts.join(previous, "chunk_id", "left").select(
        "chunk_id", "row_num", "low_key", high.alias("high_key")
    )


@dataclass(frozen=True)
class ChunkPlan:
    """Cut keys on the driver: as text, and as numbers (or text) in key order.

    ``splits[chunk]`` tells over how many tasks a chunk spreads: a key that
    fills several boundaries leaves its chunk that many times too large.
    """

    key: str
    cuts: tuple[str, ...]
    ordinals: tuple
    splits: dict[int, int]

    @property
    def chunks(self) -> int:
        return len(self.cuts) + 1


def plan_chunks(df: DataFrame, key: str, chunk_rows: int) -> ChunkPlan:
    """Bring the boundaries to the driver: rows / chunk_rows small rows, checked."""
    found, total = keys_at_multiples(df, key, chunk_rows)
    ranges = total // chunk_rows
    if ranges > MAX_CHUNKS:
        raise ValueError(f"{ranges} chunks of {chunk_rows} rows, {MAX_CHUNKS} allowed: raise the chunk size")
    # The last boundary is no cut: its range stays open.
    cuts = found.where(F.col("row_num") < ranges * chunk_rows)
    rows = cuts.select(
        "row_num", F.col("cut").cast("string").alias("cut"), ordinal(cuts, "cut").alias("o")
    ).collect()
    rows.sort(key=lambda r: r["row_num"])
    ordinals = tuple(r["o"] for r in rows)
    nulls = df.where(F.col(key).isNull()).count()
    splits = {NULL_CHUNK: -(-nulls // chunk_rows)}
    for cut in ordinals:
        # Repeated cuts leave empty ranges; the last of them holds all their rows.
        chunk = bisect_right(ordinals, cut)
        splits[chunk] = splits.get(chunk, 0) + 1
    return ChunkPlan(key, tuple(r["cut"] for r in rows), ordinals, splits)


def assign_chunks(df: DataFrame, plan: ChunkPlan, name: str = "chunk_id") -> DataFrame:
    """Add the chunk of each row: how many cuts lie at or below its key."""
    key = F.col(plan.key)
    if len(plan.cuts) <= _CASE_CUTS:
        dtype = df.schema[plan.key].dataType
        literals = [F.lit(c).cast(dtype) for c in plan.cuts]
        number = halving_case(key, literals, 0, len(literals))
    else:
        number = search_cuts(ordinal(df, plan.key), plan.ordinals)
    chunk = F.when(key.isNull(), F.lit(NULL_CHUNK)).otherwise(number)
    return df.withColumn(name, chunk.cast("int"))


def spread_by_chunk(
    df: DataFrame, plan: ChunkPlan, tasks_per_chunk: int = 1, name: str = "chunk_id"
) -> DataFrame:
    """Shuffle so that a chunk is the work of up to ``tasks_per_chunk`` tasks, and an
    oversized chunk that of as many more as it is larger; small chunks share a task.

    The rows of one chunk are told apart by the task that read them, which stays
    the same when a task runs again.
    """
    slots = F.lit(tasks_per_chunk)
    if any(n > 1 for n in plan.splits.values()):
        wide = [max(1, plan.splits.get(c, 1)) * tasks_per_chunk for c in range(NULL_CHUNK, plan.chunks)]
        # Looked up by position: a map is searched entry by entry for every row.
        slots = F.coalesce(F.get(constant_array(wide), F.col(name) - NULL_CHUNK).cast("int"), slots)
    tagged = df.withColumn("__slot", F.pmod(F.hash(F.spark_partition_id()), slots))
    # Repeated cuts leave empty chunks, so the slots of all are about this many.
    tasks = min((plan.chunks + 1) * tasks_per_chunk + plan.splits.get(NULL_CHUNK, 0) * tasks_per_chunk, MAX_TASKS)
    return tagged.repartition(min(tasks, _tasks_by_size(df) or tasks), name, "__slot").drop("__slot")


def _tasks_by_size(df: DataFrame) -> int | None:
    """Tasks for the size of the tables read, the session's number at least; None when no size is known.

    One task per chunk would be one per few rows when chunks are small, and each task's
    report goes to the driver.
    """
    known = estimated_bytes(df)
    if known is None:
        return None
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-known // (TASK_MB << 20)))


def range_predicates(plan: ChunkPlan, dtype: T.DataType) -> list[str]:
    """The ranges as SQL conditions, one per parallel read of an external database.

    Text and timestamps are quoted; the last condition takes the rows without a key.
    """
    def shown(cut: str) -> str:
        if isinstance(dtype, T.NumericType):
            return cut
        return "'" + cut.replace("'", "''") + "'"

    edges = [None, *plan.cuts, None]
    conditions = []
    for low, high in zip(edges, edges[1:]):
        if low is not None and low == high:
            continue
        parts = [f"{plan.key} >= {shown(low)}"] if low is not None else []
        parts += [f"{plan.key} < {shown(high)}"] if high is not None else []
        conditions.append(" AND ".join(parts) or f"{plan.key} IS NOT NULL")
    return [*conditions, f"{plan.key} IS NULL"]


def chunk_decision(profiles: DataFrame, settings: Settings) -> DataFrame:
    """Add ``in_one_piece`` to table profiles (``size_mb``, ``weeks``; -1 = open window)."""
    size, weeks = F.col("size_mb"), F.col("weeks")
    short_window = (
        (size < settings.windowed_table_mb) & (weeks > 0) & (weeks < settings.window_weeks)
    )
    small = size < settings.whole_table_mb
    decision = short_window | small | F.lit(not settings.chunking)
    return profiles.withColumn("in_one_piece", decision)
