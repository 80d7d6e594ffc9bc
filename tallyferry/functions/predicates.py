"""Row predicates as Columns. All of them reach the parquet scan as pushed filters."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.specs import Window


def conjoin(*conditions: Column | None) -> Column:
    """AND of the conditions given; TRUE when there is none."""
    given = [c for c in conditions if c is not None]
    return reduce(and_, given) if given else F.lit(True)


def typed_literal(df: DataFrame, column: str, value: object) -> Column:
    """``value`` as a literal of the column's own type, so the filter stays pushable."""
    return F.lit(str(value)).cast(df.schema[column].dataType)


def date_window(df: DataFrame, column: str | None, window: Window | None) -> Column:
    """Half-open window; one comparison when an end is open; TRUE without a date column."""
    if column is None or not window:
        return F.lit(True)
    lower = upper = None
    if window.start is not None:
        lower = F.col(column) >= typed_literal(df, column, window.start)
    if window.end is not None:
        upper = F.col(column) < typed_literal(df, column, window.end)
    return conjoin(lower, upper)


def key_range(
    df: DataFrame, column: str, low: object, high: object, extra: Column | None = None
) -> Column:
    """``[low, high)`` on the key; a bound that is None is open."""
    lower = F.col(column) >= typed_literal(df, column, low) if low is not None else None
    upper = F.col(column) < typed_literal(df, column, high) if high is not None else None
    return conjoin(lower, upper, extra)


def outside(condition: Column) -> Column:
    """Rows a SQL DELETE on ``condition`` keeps: FALSE and NULL alike."""
    return ~F.coalesce(condition, F.lit(False))
