"""Per-class checksums of a table.

Text, number and float checksums share one aggregate without a shuffle of rows.
The temporal checksum reads only the temporal columns, in a plan of its own, so
that its distinct keys never carry the other aggregates' buffers along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyferry.functions.digests import row_digest
from tallyferry.functions.exact import exact_sum, exact_sum_sql
from tallyferry.functions.scalars import ordinal
from tallyferry.functions.text import quoted
from tallyferry.operators.columns import UNCHECKED, columns_of_class

_ROW = "__rows"


# Built as SQL text: a wide table would take thousands of calls to the JVM otherwise.
def _mean(df: DataFrame, name: str, kind: str) -> str:
    """Average over all rows with NULL as 0 (or as empty text); NULL without rows."""
    cell = quoted(name)
    if kind == "string":
        total = f"coalesce(sum(cast(length({cell}) as bigint)), 0)"
    elif kind == "number":
        total = exact_sum_sql(cell, df.schema[name].dataType)
    else:
        total = f"coalesce(sum(cast({cell} as double)), 0)"
    return f"try_divide(cast({total} as double), cast(count(1) as double))"


def _averages(df: DataFrame, kind: str) -> tuple[Column, Column]:
    """The checksum of one class (rounded per column and in total) and its unrounded twin."""
    means = [_mean(df, c, kind) for c in columns_of_class(df, kind)]
    if not means:
        nothing = F.lit(None).cast("double")
        return nothing, nothing
    rounded = " + ".join(f"round({m}, 2)" for m in means)
    return F.expr(f"round({rounded}, 2)"), F.expr(" + ".join(means))


def checksums(
    df: DataFrame,
    table_name: str,
    where: Column | None = None,
    by: Sequence[str] = (),
    fingerprint: str | None = None,
    classes: Sequence[str] = ("string", "number", "float", "temporal"),
) -> DataFrame:
    """Rows (``table_name``, *by*, ``checksum_class``, ``column_count``, ``value``,
    ``raw_value``, ``digest``, ``row_count``), one per class, plus ``unchecked`` when
    columns fall outside every class and ``fingerprint`` when an algorithm is named.

    ``where`` restricts every checksum; ``by`` gives one set per group.
    """
    sliced = df if where is None else df.where(where)
    plain = sliced.drop(*by) if by else sliced
    parts = []
    aggregates = [F.count(F.lit(1)).alias(_ROW)]
    for kind in classes:
        if kind != "temporal":
            value, raw = _averages(plain, kind)
            aggregates += [value.alias(f"{kind}_value"), raw.alias(f"{kind}_raw")]
            count = len(columns_of_class(plain, kind))
            parts.append(_line(kind, count, f"{kind}_value", f"{kind}_raw"))
    temporal = columns_of_class(plain, "temporal")
    if "temporal" in classes and not temporal:
        parts.append(_line("temporal", 0))
    unchecked = columns_of_class(plain, UNCHECKED)
    if unchecked:
        parts.append(_line(UNCHECKED, len(unchecked)))
    if fingerprint:
        sliced = sliced.withColumn("__digest", row_digest(plain, fingerprint))
        aggregates.append(exact_sum("__digest", T.LongType()).alias("__digest_sum"))
        parts.append(_line("fingerprint", len(plain.columns), digest="__digest_sum"))

    names = ["table_name", *by, "checksum_class", "column_count", "value", "raw_value", "digest",
             "row_count"]
    lines = []
    if parts:
        summed = sliced.groupBy(*by).agg(*aggregates)
        lines.append(
            summed.select(
                *by, F.col(_ROW).alias("row_count"), F.expr(f"inline(array({', '.join(parts)}))")
            )
        )
    if "temporal" in classes and temporal:
        lines.append(_distinct_counts(sliced, temporal, by))
    result = lines[0]
    for more in lines[1:]:
        result = result.unionByName(more)
    return result.withColumn("table_name", F.lit(table_name)).select(*names)


def _line(kind: str, columns: int, value: str = "null", raw: str = "null",
          digest: str = "null") -> str:
    return (
        f"named_struct('checksum_class', '{kind}', 'column_count', cast({columns} as bigint), "
        f"'value', cast({value} as double), 'raw_value', cast({raw} as double), "
        f"'digest', cast({digest} as decimal(38,0)))"
    )


def _distinct_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Sum of distinct counts: dates by bitmaps, finer times by their values."""
    days = [c for c in columns if isinstance(df.schema[c].dataType, T.DateType)]
    times = [c for c in columns if c not in days]
    # Rows are counted once, by the first column of one of the two.
    parts = ([_day_bitmaps(df, days, by, True)] if days else []) + ([_value_pairs(df, times, by, not days)] if times else [])
    counted = parts[0]
    for more in parts[1:]:
        counted = counted.unionByName(more)
    total = counted.groupBy(*by).agg(
        F.coalesce(F.sum("found"), F.lit(0)).cast("double").alias("value"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
    )
    return total.select(
        *by,
        F.lit("temporal").alias("checksum_class"),
        F.lit(len(columns)).cast("bigint").alias("column_count"),
        "value",
        F.col("value").alias("raw_value"),
        F.lit(None).cast("decimal(38,0)").alias("digest"),
        "row_count",
    )


def _cells(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per cell: the column's number ``i`` and its value ``v`` as a long."""
    cells = [
        F.struct(F.lit(i).alias("i"), ordinal(df, c).cast("bigint").alias("v"))
        for i, c in enumerate(columns)
    ]
    return df.select(*by, F.inline(F.array(*cells)))


def _rows_of_first(counting: bool) -> Column:
    return F.when((F.col("i") == 0) & F.lit(counting), F.col("n")).otherwise(0).alias("n")


def _value_pairs(df: DataFrame, columns: Sequence[str], by: Sequence[str], counting: bool) -> DataFrame:
    """One row per (column, value) after map-side combining.

    NULLs are kept as pairs, because rows are counted by the first column's.
    """
    pairs = _cells(df, columns, by).groupBy(*by, "i", "v").agg(F.count(F.lit(1)).alias("n"))
    return pairs.select(*by, F.col("v").isNotNull().cast("bigint").alias("found"), _rows_of_first(counting))


def _day_bitmaps(df: DataFrame, columns: Sequence[str], by: Sequence[str], counting: bool) -> DataFrame:
    """One bitmap of 4 KB per column and 90 years: what a task shuffles is bounded by the range
    of days, not by its rows. Bitmaps of the same days are merged by OR."""
    marked = _cells(df, columns, by).groupBy(*by, "i", F.expr("bitmap_bucket_number(v)").alias("years")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(v))").alias("days"), F.count(F.lit(1)).alias("n")
    )
    return marked.select(*by, F.expr("bitmap_count(days)").alias("found"), _rows_of_first(counting))


def table_counts(df: DataFrame, table_name: str) -> DataFrame:
    """Row count of one table, labelled."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table_name).alias("table_name"), "row_count"
    )


def table_fingerprint(df: DataFrame, table_name: str, algorithm: str = "xxhash64") -> DataFrame:
    """Order-free hash of a whole table: sum of 60-bit row digests, and the row count.

    A sum, not XOR: pairs of equal rows must not cancel out.
    """
    rows = df.select(row_digest(df, algorithm).alias("d"))
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"), exact_sum("d", T.LongType()).alias("fingerprint")
    ).select(F.lit(table_name).alias("table_name"), "row_count", "fingerprint")
