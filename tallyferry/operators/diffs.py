"""Row and cell differences between two copies of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.functions.digests import comparable
from tallyferry.functions.predicates import conjoin
from tallyferry.functions.text import quoted
from tallyferry.operators.ordering import number_rows


class RepeatedKey(ValueError):
    """A key does not identify rows; use ``positional_diff`` or ``multiset_diff``."""


def multiset_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows one copy has more often than the other: all columns, ``side`` and ``copies``.

    Both directions in one aggregate: source rows count +1, target rows -1.
    Copies of a row are combined before the shuffle, and the surplus is given as
    a number rather than repeated rows, so a row that fills a third of the table
    costs no more than any other.
    """
    columns = source.columns
    both = source.withColumn("__sign", F.lit(1)).unionByName(
        target.select(*[quoted(c) for c in columns]).withColumn("__sign", F.lit(-1))
    )
    net = both.groupBy(*[quoted(c) for c in columns]).agg(F.sum("__sign").alias("__net"))
    return net.where(F.col("__net") != 0).select(
        *[F.col(quoted(c)) for c in columns],
        F.when(F.col("__net") > 0, "source").otherwise("target").alias("side"),
        F.abs("__net").cast("bigint").alias("copies"),
    )


def field_diff(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    check_keys: bool = True,
) -> DataFrame:
    """Cells that differ: *keys*, ``column_name``, ``source_value``, ``target_value``, ``kind``.

    Rows are matched on ``keys``, which must be unique on either side (checked
    unless ``check_keys`` is off). A row only one side has gives one line of kind
    ``source_only`` or ``target_only`` without a column name.
    """
    if check_keys:
        for side, df in (("source", source), ("target", target)):
            repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            if not repeated.isEmpty():
                raise RepeatedKey(f"{list(keys)} repeats in the {side} table")
    compared = list(columns) if columns is not None else [c for c in source.columns if c not in keys]
    left = _packed(source, keys, compared, "source")
    right = _packed(target, keys, compared, "target").withColumnsRenamed(
        {k: f"__{k}" for k in keys}
    )
    same_key = conjoin(*[F.col(quoted(k)).eqNullSafe(F.col(quoted(f"__{k}"))) for k in keys])
    joined = left.join(right, same_key, "full_outer").select(
        *[F.coalesce(quoted(k), quoted(f"__{k}")).alias(k) for k in keys], "source", "target"
    )
    # One struct comparison per row; cells are only looked at in rows that differ.
    rows = joined.where(~F.col("source").eqNullSafe(F.col("target")))
    both = F.col("source").isNotNull() & F.col("target").isNotNull()
    lines = [_line(None, F.lit(None), F.lit(None), ~both)]
    for name in compared:
        here, there = _cell("source", name), _cell("target", name)
        lines.append(_line(name, here, there, both & ~here.eqNullSafe(there)))
    kind = (
        F.when(F.col("target").isNull(), "source_only")
        .when(F.col("source").isNull(), "target_only")
        .otherwise("changed")
    )
    differing = F.filter(F.array(*lines), lambda line: line.getField("keep"))
    return rows.select(*keys, kind.alias("kind"), F.inline(differing)).select(
        *keys, "column_name", "source_value", "target_value", "kind"
    )


def _packed(df: DataFrame, keys: Sequence[str], columns: Sequence[str], side: str) -> DataFrame:
    # A struct with a constant is never NULL, so its absence marks a missing row.
    cells = [F.expr(comparable(c, df.schema[c].dataType)).alias(c) for c in columns]
    return df.select(*keys, F.struct(F.lit(True).alias("__here"), *cells).alias(side))


def _cell(side: str, name: str) -> Column:
    return F.col(side).getField(name)


def _line(name: str | None, source: Column, target: Column, keep: Column) -> Column:
    return F.struct(
        F.lit(name).cast("string").alias("column_name"),
        source.cast("string").alias("source_value"),
        target.cast("string").alias("target_value"),
        keep.alias("keep"),
    )


def positional_diff(
    source: DataFrame, target: DataFrame, first_rows: int | None = None
) -> DataFrame:
    """Cell differences of two tables without a key: both are put in order of all
    their columns and matched by position. ``first_rows`` compares only the start.
    """
    left = number_rows(source, source.columns)
    right = number_rows(target.select(*source.columns), source.columns)
    if first_rows is not None:
        left = left.where(F.col("row_num") <= first_rows)
        right = right.where(F.col("row_num") <= first_rows)
    return field_diff(left, right, ["row_num"], source.columns, check_keys=False)
