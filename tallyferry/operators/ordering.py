"""Exact positions in a global order, without a one-task window.

A window without PARTITION BY moves the whole table through one task. Here the
rows are range-partitioned and sorted in parallel, their local positions are
written with them, and a running offset per partition turns local positions
into global ones. The reading task joins as the last sort column, so equal keys
spread over many range partitions, however many rows share one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyferry.functions.scalars import ordinal_literal
from tallyferry.operators.ranks import key_at
from tallyferry.session import materialise, partitions_for

_SPREAD, _PART, _POS = "__spread", "__part", "__pos"
_POSITION_BITS = (1 << 33) - 1  # the row part of monotonically_increasing_id

# A limit merges so many rows in one task; above this they are numbered in parallel.
TOP_K_LIMIT = 50_000


def number_rows(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "row_num"
) -> DataFrame:
    """Add ROW_NUMBER() over the global ascending order.

    Rows equal on every sort column are numbered in no particular order. One
    shuffle of the given columns, one write and one read of the sorted rows.
    """
    # The task index is stable when a task runs again, unlike a random salt.
    tagged = df.withColumn(_SPREAD, F.spark_partition_id())
    order = [*order_by, _SPREAD]
    wanted = partitions_for(df)
    ranged = (
        tagged.repartitionByRange(wanted, *order) if wanted else tagged.repartitionByRange(*order)
    )
    # Written once: range bounds are sampled, so two runs may cut differently.
    placed = materialise(
        ranged.sortWithinPartitions(*order)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)))
        .drop(_SPREAD),
        "numbered",
    )
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: bounded by the number of partitions, whatever the data.
    offsets = (
        placed.groupBy(_PART)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(_PART, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    return placed.join(F.broadcast(offsets), _PART).select(
        *df.columns, (F.col("offset") + F.col(_POS) + 1).alias(name)
    )


def top_rows(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The ``rows`` rows with the highest keys, in descending order; NULL keys are the lowest.

    The key at that position is found first, so one pushed filter picks the rows and only they
    are sorted, however many are asked for.
    """
    if rows <= 0:
        return df.limit(0)
    found = key_at(df, key, rows, descending=True)
    column = F.col(key)
    if found is None:
        given = df.where(column.isNotNull())
        picked = given.unionByName(_some(df.where(column.isNull()), rows - given.count()))
    else:
        threshold = ordinal_literal(df, key, found.ordinal)
        if max(rows, found.last - found.first) <= TOP_K_LIMIT:
            # So few rows pass the filter that one task can merge them.
            return df.where(column >= threshold).orderBy(column.desc()).limit(rows)
        missing = rows - (found.total - found.last)
        if missing == found.last - found.first + 1:
            picked = df.where(column >= threshold)
        else:
            picked = df.where(column > threshold).unionByName(_some(df.where(column == threshold), missing))
    return picked.orderBy(column.desc())


def _some(df: DataFrame, rows: int) -> DataFrame:
    """Any ``rows`` rows; many are numbered in parallel instead of passing through one task."""
    if rows <= TOP_K_LIMIT:
        return df.limit(rows)
    return number_rows(df, [], "__place").where(F.col("__place") <= rows).drop("__place")


def newest(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The same without NULL keys."""
    return top_rows(df.where(F.col(key).isNotNull()), key, rows)


def key_at_position(df: DataFrame, key: str, position: int) -> DataFrame:
    """One row: the key at ``position`` in descending order (``key``) and its RANK
    (``ranking``); both NULL when the table has fewer non-null keys."""
    found = key_at(df, key, position, descending=True)
    value = F.lit(None).cast(df.schema[key].dataType) if found is None else ordinal_literal(df, key, found.ordinal)
    ranking = F.lit(None if found is None else found.total - found.last + 1).cast("bigint")
    return df.sparkSession.range(1).select(value.alias("key"), ranking.alias("ranking"))
