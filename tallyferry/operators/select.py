"""Selecting the slice to move: scans, windows, key ranges and newest-n samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.functions.predicates import conjoin, key_range, typed_literal
from tallyferry.functions.scalars import ordinal, ordinal_literal
from tallyferry.operators.ordering import key_at_position, newest, top_rows


def scan_select(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    predicate: Column | None = None,
    newest_by: str | None = None,
    limit: int = 0,
) -> DataFrame:
    """Projection, predicate, descending order and limit; order plus limit is a top-k."""
    selected = df.where(conjoin(predicate))
    if columns is not None:
        selected = selected.select(*dict.fromkeys([*columns, *([newest_by] if newest_by else [])]))
    if newest_by is not None and limit > 0:
        selected = top_rows(selected, newest_by, limit)
    elif newest_by is not None:
        selected = sort_desc(selected, newest_by)
    elif limit > 0:
        selected = selected.limit(limit)
    return selected.select(*columns) if columns is not None else selected


def sort_desc(df: DataFrame, key: str) -> DataFrame:
    """Whole table in descending key order.

    The reading task is the last sort column, so that range partitioning can
    cut through the rows of a hot key.
    """
    spread = df.withColumn("__spread", F.spark_partition_id())
    return spread.orderBy(F.col(key).desc(), "__spread").drop("__spread")


def max_key(df: DataFrame, key: str) -> DataFrame:
    """High-water mark of a column."""
    return df.agg(F.max(key).alias("max_key"))


def latest_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Rows whose RANK by descending key is at most ``rows``, ties included.

    The key at that position is a threshold; the second scan is a pushed filter.
    A table with fewer rows qualifies whole.
    """
    threshold = scalar_text(key_at_position(df, key, rows), "key")
    if threshold is None:
        return df
    return df.where(F.col(key) >= typed_literal(df, key, threshold))


def scalar_text(df: DataFrame, column: str) -> str | None:
    """The single value of a one-row table as text; Spark's text form keeps every digit."""
    row = df.select(F.col(column).cast("string")).first()
    return None if row is None else row[0]


def sample_threshold_full(df: DataFrame, key: str, rank: int) -> DataFrame:
    """The key whose RANK is exactly ``rank``; NULL when ties skip that rank."""
    at = key_at_position(df, key, rank)
    return at.select(F.when(F.col("ranking") == rank, F.col("key")).alias("threshold"))


def sample_threshold(
    df: DataFrame, key: str, sample_size: int, date_col: str, floor: Column
) -> DataFrame:
    """Lower end of a newest-``sample_size`` slice: the key at rank n+1 among the
    rows dated after ``floor``, or the table's smallest key when no row has that rank."""
    recent = df.where(F.col(date_col) > floor)
    at = sample_threshold_full(recent, key, sample_size + 1)
    return fallback_scalar(at, "threshold", df.agg(F.min(key).alias("smallest")), "smallest")


def fallback_scalar(first: DataFrame, first_col: str, second: DataFrame, second_col: str) -> DataFrame:
    """The first one-row candidate that is not NULL."""
    candidates = first.select(F.lit(1).alias("priority"), F.col(first_col).alias(first_col)).unionByName(
        second.select(F.lit(2).alias("priority"), F.col(second_col).alias(first_col))
    )
    given = candidates.where(F.col(first_col).isNotNull())
    return given.agg(F.min_by(first_col, "priority").alias(first_col))


def sample_date_floor(df: DataFrame, key: str, date_col: str, sample_size: int) -> DataFrame:
    """Oldest date among the 3n rows with the highest keys."""
    top = newest(df.select(key, date_col), key, 3 * sample_size)
    return top.agg(F.min(date_col).alias("date_floor"))


def date_floor(df: DataFrame, key: str, date_col: str, sample_size: int) -> Column | None:
    """The same date as a constant; None when no such row has a date."""
    found = sample_date_floor(df, key, date_col, sample_size)
    value = found.select(ordinal(found, "date_floor")).first()[0]
    return None if value is None else ordinal_literal(df, date_col, value)


def sample_slice(
    df: DataFrame,
    key: str,
    sample_size: int,
    date_col: str | None = None,
    floor: object | None = None,
    include_max: bool = False,
) -> tuple[str | None, str | None, Column]:
    """Bounds and predicate of a newest-n slice: ``[threshold, max)``.

    The newest key itself stays out unless ``include_max`` is set, because rows
    with that key may still be arriving.
    """
    recent = df
    if date_col is not None and floor is not None:
        after = floor if isinstance(floor, Column) else typed_literal(df, date_col, floor)
        recent = df.where(F.col(date_col) > after)
    low = scalar_text(sample_threshold_full(recent, key, sample_size + 1), "threshold")
    if low is None:
        low = scalar_text(df.agg(F.min(key).alias("smallest")), "smallest")
    high = scalar_text(max_key(df, key), "max_key")
    return low, high, key_range(df, key, low, None if include_max else high)
