"""Keys at given positions of a column's order, exact, without sorting the table.

A sample of keys gives split keys; a scan counts the rows of every interval between
them, and of every split key itself, so a hot key is an interval of its own. Running sums
of these counts tell which intervals hold the wanted positions. Only those are looked at
closer: a single position is narrowed down until few rows are left, many positions
are found inside their intervals at once. Positions and ties are exact, whatever the sample was;
it only decides how much is left to look at.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyferry.functions.scalars import ordinal
from tallyferry.operators.intervals import between_cuts, is_cut

_KEY, _ORD, _PART, _AT = "__key", "__ordinal", "__part", "__at_split"

#: Rows among which a position is found by one small sort.
BRACKET_ROWS = 1_000_000
#: Split keys of one narrowing step: few enough for a CASE in codegen.
NARROW_SPLITS = 63
#: Split keys per wanted position, and at most.
SPLITS_EACH, MAX_SPLITS = 16, 100_000
#: Sampled keys per split.
SAMPLED_EACH = 8


class Found(NamedTuple):
    """A key as its ordinal, the ascending positions that its ties take, and the number of non-null keys."""

    ordinal: object
    first: int
    last: int
    total: int


def non_null_keys(df: DataFrame, key: str) -> DataFrame:
    """The non-null keys beside their ordinals, which all comparisons use."""
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias(_KEY), ordinal(df, key).alias(_ORD))


def split_keys(keys: DataFrame, rows: int, wanted: int) -> list:
    """About ``wanted`` different ordinals in order, from a sample of bounded size."""
    if wanted < 1:
        return []
    sample = keys.sample(min(1.0, wanted * SAMPLED_EACH / rows), seed=17) if rows > wanted * SAMPLED_EACH else keys
    # As Arrow columns: a distributed sort with a limit would send rows of many times this size.
    seen = sample.select(_ORD).toArrow()
    count, size = min(wanted, seen.num_rows), seen.num_rows
    order = pc.sort_indices(seen, sort_keys=[(_ORD, "ascending")])
    picked = seen.column(_ORD).take(order.take(pa.array([size * (2 * i + 1) // (2 * count) for i in range(count)], pa.int64())))
    return list(dict.fromkeys(picked.to_pylist()))


def _counted(keys: DataFrame, splits: list) -> list:
    """(interval, whether its split key itself, rows) in order; interval k lies above k split keys."""
    rows = _placed(keys, splits).groupBy(_PART, _AT).agg(F.count(F.lit(1)).alias("n")).collect()
    # A split key begins its interval.
    return sorted(rows, key=lambda r: (r[_PART], not r[_AT]))


def _placed(keys: DataFrame, splits: list) -> DataFrame:
    if not splits:
        return keys.withColumn(_PART, F.lit(0)).withColumn(_AT, F.lit(False))
    placed = keys.withColumn(_PART, between_cuts(F.col(_ORD), splits))
    return placed.withColumn(_AT, is_cut(F.col(_ORD), splits, F.col(_PART)))


def key_at(df: DataFrame, key: str, position: int, descending: bool = False, bracket_rows: int | None = None) -> Found | None:
    """The key at a position (from 1) of the order of non-null keys; None beyond its end."""
    bracket_rows = BRACKET_ROWS if bracket_rows is None else bracket_rows
    keys = non_null_keys(df, key)
    total = rows = keys.count()
    if not 1 <= position <= total:
        return None
    wanted, before = (total - position + 1 if descending else position), 0
    while rows > bracket_rows:
        splits = split_keys(keys, rows, NARROW_SPLITS) or [keys.first()[_ORD]]
        for part in _counted(keys, splits):
            if before + part["n"] >= wanted:
                break
            before += part["n"]
        low = splits[part[_PART] - 1] if part[_PART] else None
        if part[_AT]:
            return Found(low, before + 1, before + part["n"], total)
        # Split keys themselves are counted apart, so every step leaves some rows behind.
        if low is not None:
            keys = keys.where(F.col(_ORD) > F.lit(low))
        if part[_PART] < len(splits):
            keys = keys.where(F.col(_ORD) < F.lit(splits[part[_PART]]))
        rows = part["n"]
    # At most ``bracket_rows`` rows are ordered here.
    spans = _spans(keys.groupBy(_ORD).agg(F.count(F.lit(1)).alias("n")), Window.orderBy(_ORD), F.lit(before))
    hit = spans.where((F.col("first") <= wanted) & (F.col("last") >= wanted)).first()
    return Found(hit[_ORD], hit["first"], hit["last"], total)


def _spans(counts: DataFrame, order, before: Column) -> DataFrame:
    """The first and last position of every counted key."""
    return counts.withColumn("last", before + F.sum("n").over(order)).withColumn("first", F.col("last") - F.col("n") + 1)


def keys_at_multiples(df: DataFrame, key: str, step: int) -> tuple[DataFrame, int]:
    """Each ``step``-th non-null key: ``row_num`` and ``cut``, and how many non-null keys there are.

    Only keys of intervals that hold a wanted position are shuffled, once per different key.
    """
    keys = non_null_keys(df, key)
    total = keys.count()
    splits = split_keys(keys, total, min(MAX_SPLITS, SPLITS_EACH * (total // step))) if total > BRACKET_ROWS and total >= step else []
    offsets, before = [], 0
    for part in _counted(keys, splits) if splits else [{_PART: 0, _AT: False, "n": total}]:
        if (before + part["n"]) // step > before // step:
            offsets.append((part[_PART], part[_AT], before))
        before += part["n"]
    # Two rows per split at most.
    shape = pa.schema([(_PART, pa.int32()), (_AT, pa.bool_()), ("before", pa.int64())])
    columns = [[row[i] for row in offsets] for i in range(3)]
    wanted = df.sparkSession.createDataFrame(pa.table(columns, schema=shape))
    inside = _placed(keys, splits).join(F.broadcast(wanted), [_PART, _AT])
    counts = inside.groupBy(_PART, _AT, "before", _KEY, _ORD).agg(F.count(F.lit(1)).alias("n"))
    spans = _spans(counts, Window.partitionBy(_PART, _AT).orderBy(_ORD), F.col("before"))
    low, high = F.expr(f"(first - 1) div {step} + 1"), F.expr(f"last div {step}")
    hits = spans.where(low <= high).select(F.explode(F.sequence(low, high)).alias("m"), F.col(_KEY).alias("cut"))
    return hits.select((F.col("m") * step).alias("row_num"), "cut"), total

