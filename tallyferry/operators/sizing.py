"""Table sizes: from the data in one pass, from storage metadata, and per segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyferry.functions.scalars import megabytes
from tallyferry.functions.text import quoted
from tallyferry.session import estimated_bytes


def row_bytes(df: DataFrame) -> Column:
    """Bytes of one row: text by its UTF-8 length, other scalars 8, NULL 0."""
    cells = [_cell_bytes(quoted(f.name), f.dataType) for f in df.schema.fields]
    return F.expr(" + ".join(cells))


def _cell_bytes(cell: str, dtype: T.DataType) -> str:
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        size = f"octet_length({cell})"
    elif isinstance(dtype, T.ArrayType) and not isinstance(
        dtype.elementType, (T.StringType, T.ArrayType, T.MapType, T.StructType)
    ):
        size = f"size({cell}) * 8"
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        size = f"octet_length(to_json({cell}))"
    else:
        size = "8"
    return f"cast(if({cell} is null, 0, {size}) as bigint)"


def table_size(df: DataFrame, table_name: str) -> DataFrame:
    """``table_name``, ``row_count``, ``bytes`` and ``size_mb`` (to hundreds, 0 when empty)."""
    measured = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(row_bytes(df)), F.lit(0)).cast("bigint").alias("bytes"),
    )
    return measured.select(
        F.lit(table_name).alias("table_name"),
        "row_count",
        "bytes",
        megabytes(F.col("bytes"), -2).alias("size_mb"),
    )


def stored_mb(df: DataFrame) -> float:
    """Size from file metadata or catalog statistics; one pass over the rows when there is none."""
    known = estimated_bytes(df)
    if known is None:
        known = table_size(df, "").first()["bytes"]
    return known / (1024.0 * 1024.0)


def analyzed_bytes(spark: SparkSession, table: str) -> int | None:
    """Bytes that ``ANALYZE TABLE`` recorded for a catalog table; None without statistics."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    row = described.where(F.col("col_name") == "Statistics").select("data_type").first()
    return int(row[0].split(" ")[0]) if row else None


def rows_per_chunk(sizes: DataFrame, chunk_mb: float) -> DataFrame:
    """Rows that make ``chunk_mb`` of a table, to thousands, from ``table_size`` rows.

    0 means that a table is too small to be cut at that size.
    """
    used_mb = F.round(F.col("bytes") / F.lit(1024.0 * 1024.0), 1)
    mb_per_row = F.try_divide(used_mb, F.col("row_count").cast("double"))
    rows = F.round(F.try_divide(F.lit(float(chunk_mb)), mb_per_row), -3)
    return sizes.select(
        "table_name",
        used_mb.alias("used_mb"),
        "row_count",
        F.coalesce(rows, F.lit(0.0)).cast("bigint").alias("chunk_rows"),
    )


def chunk_rows_for(used_mb: float, rows: int, chunk_mb: float) -> int:
    """The same rule on driver-side numbers; at least 1."""
    if used_mb <= 0 or rows <= 0:
        return max(rows, 1)
    wanted = chunk_mb / (used_mb / rows)
    return int(wanted / 1000 + 0.5) * 1000 or max(int(wanted), 1)


def two_level_max(df: DataFrame, outer: Sequence[str], inner: Sequence[str], value: Column) -> DataFrame:
    """Sum of ``value`` per segment, then the largest segment per table.

    Hot segments are summed before the shuffle (partial aggregation).
    """
    per_segment = df.groupBy(*outer, *inner).agg(F.sum(value).alias("total"))
    return per_segment.groupBy(*outer).agg(
        F.max("total").alias("largest"), F.count(F.lit(1)).alias("segments")
    )


def size_by_segment(
    rows: DataFrame, fact_key: str, segments: DataFrame, segment_key: str, by: str,
    only: Column | None = None,
) -> DataFrame:
    """Bytes and rows of a table per attribute of a joined segment table.

    Rows are summed per join key first, so a hot key meets the join as one row.
    ``only`` is an extra condition of the join on the segment side.
    """
    per_key = rows.groupBy(fact_key).agg(
        F.sum(row_bytes(rows)).alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    condition = F.col(fact_key) == F.col(segment_key)
    if only is not None:
        condition = condition & only
    joined = per_key.join(segments, condition, "inner")
    return joined.groupBy(by).agg(
        F.sum("bytes").alias("bytes"),
        F.sum("rows").alias("row_count"),
        megabytes(F.sum("bytes"), 1).alias("size_mb"),
    )
