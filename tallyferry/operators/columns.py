"""Columns of a table: listing, naming, checksum classes, schema comparison."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyferry.functions.text import quoted

UNCHECKED = "unchecked"
CHECKED_CLASSES = ("string", "number", "float", "temporal")


def checksum_class(dtype: T.DataType) -> str:
    """The checksum class a type belongs to; booleans and nested types are unchecked."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "string"
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        return "number"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "float"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "temporal"
    if dtype.typeName().startswith("time"):
        return "temporal"
    return UNCHECKED


def columns_of_class(df: DataFrame, wanted: str) -> list[str]:
    return [f.name for f in df.schema.fields if checksum_class(f.dataType) == wanted]


def list_columns(df: DataFrame) -> DataFrame:
    """One row per column: position, type, checksum class, rows and non-null rows.

    The counts come from one aggregate over the table; they stand in for NOT
    NULL constraints, which file tables do not enforce.
    """
    described = [
        F.struct(
            F.lit(i).cast("int").alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.lit(checksum_class(field.dataType)).alias("checksum_class"),
            F.col("row_count"),
            F.col(f"n{i}").alias("non_null_rows"),
        )
        for i, field in enumerate(df.schema.fields, start=1)
    ]
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count(F.col(quoted(c))).alias(f"n{i}") for i, c in enumerate(df.columns, start=1)],
    )
    return counts.select(F.inline(F.array(*described)))


def normalize_columns(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Lower-case every column name; ``renames`` (by lower-case name) wins."""
    chosen = renames or {}
    return df.toDF(*[chosen.get(c.lower(), c.lower()) for c in df.columns])


def shout_columns(df: DataFrame) -> DataFrame:
    """Upper-case every column name, the header style of an export file."""
    return df.toDF(*[c.upper() for c in df.columns])


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns of both tables side by side, names compared without case.

    ``status`` is ``same``, ``type_differs``, ``source_only`` or
    ``target_only``; names that repeat are matched by occurrence.
    """
    return side_by_side(_described(source, "source"), _described(target, "target"))


def side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """``schema_diff`` of two descriptions: ``column_name``, ``occurrence``, ``<side>_type``, ``<side>_non_null``."""
    joined = left.join(right, ["column_name", "occurrence"], "full_outer")
    status = (
        F.when(F.col("target_type").isNull(), "source_only")
        .when(F.col("source_type").isNull(), "target_only")
        .when(F.col("source_type") != F.col("target_type"), "type_differs")
        .otherwise("same")
    )
    return joined.select(
        "column_name",
        "source_type",
        "target_type",
        "source_non_null",
        "target_non_null",
        status.alias("status"),
    )


def _described(df: DataFrame, side: str) -> DataFrame:
    seen: dict[str, int] = {}
    rows, counts = [], []
    unique = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    for i, field in enumerate(df.schema.fields):
        name = field.name.lower()
        seen[name] = seen.get(name, 0) + 1
        counts.append(F.count(f"c{i}").alias(f"n{i}"))
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(seen[name]).alias("occurrence"),
                F.lit(field.dataType.simpleString()).alias(f"{side}_type"),
                F.col(f"n{i}").alias(f"{side}_non_null"),
            )
        )
    return unique.agg(*counts).select(F.inline(F.array(*rows)))


def unchecked_columns(df: DataFrame, table_name: str) -> DataFrame:
    """How many columns no checksum covers, with the rows they hold a value in."""
    names = columns_of_class(df, UNCHECKED)
    filled = F.lit(False)
    for name in names:
        filled = filled | F.col(quoted(name)).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(filled).alias("unchecked_rows"),
    ).select(
        F.lit(table_name).alias("table_name"),
        F.lit(len(names)).cast("bigint").alias("unchecked_columns"),
        "row_count",
        "unchecked_rows",
    )
