"""Counts and bounds of Parquet tables from their footers, without reading data pages.

The footers are read in parallel, one small row per file and column. Where a file
keeps no null count for a column (nested types, some writers), that column alone is scanned.
Stores that Arrow cannot open are read by Spark's own aggregates over footers.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timedelta, timezone

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyferry.functions.text import quoted
from tallyferry.operators.columns import checksum_class, side_by_side

#: Files whose footers one task reads.
FILES_PER_TASK = 64
#: Schemes that Arrow opens by itself; all others go through Spark's reader.
ARROW_SCHEMES = ("file", "s3", "s3a", "s3n", "gs")
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
_FACTS = "column_name string, row_count long, non_null_rows long, low long, high long"
_FOOTER = "column_name string, n_rows long, nulls long, low long, high long"


def _ordinal(value: object) -> int | None:
    """Whole numbers, days since 1970 and microseconds since 1970; None for other statistics."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, int):
        return value
    if isinstance(value, datetime):
        wall = value if value.tzinfo is None else value.astimezone(timezone.utc).replace(tzinfo=None)
        return int((wall - datetime(1970, 1, 1)) // timedelta(microseconds=1))
    return (value - date(1970, 1, 1)).days if isinstance(value, date) else None


def _footer_rows(uri: str) -> Iterator[tuple]:
    from pyarrow import fs
    from pyarrow import parquet

    kind, mark, place = uri.partition("://")
    store, path = fs.FileSystem.from_uri(f"s3://{place}" if mark and kind in ("s3a", "s3n") else uri)
    with store.open_input_file(path) as file:
        footer = parquet.read_metadata(file)
    # The file itself: a column that other files lack still belongs to all rows.
    yield None, footer.num_rows, 0, None, None
    for c in range(footer.num_columns):
        leaf = footer.schema.column(c)
        # A leaf below a list or struct says nothing about NULLs of the column itself.
        flat = leaf.path == leaf.name and leaf.max_repetition_level == 0
        groups = [footer.row_group(g).column(c).statistics for g in range(footer.num_row_groups)] if flat else [None]
        counted = all(s is not None and s.has_null_count for s in groups)
        bounds = [(_ordinal(s.min), _ordinal(s.max)) if s is not None and s.has_min_max else (None, None) for s in groups]
        full = [s is not None and s.null_count == s.num_values + s.null_count for s in groups] if counted else [False] * len(groups)
        known = [b for b, empty in zip(bounds, full) if not empty]
        sure = counted and all(low is not None for low, _ in known) and bool(known)
        yield (
            leaf.path.split(".")[0], footer.num_rows, sum(s.null_count for s in groups) if counted else None,
            min(b[0] for b in known) if sure else None, max(b[1] for b in known) if sure else None,
        )


def footer_facts(spark: SparkSession, path: str) -> DataFrame:
    """Per column: ``row_count``, ``non_null_rows``, ``low`` and ``high``; NULL where the footers do not tell.

    Bounds are the ``ordinal`` of whole numbers, dates and times. A table of no files has no rows here.
    """
    files = spark.read.parquet(path).inputFiles()
    if any(f.partition(":")[0] not in ARROW_SCHEMES for f in files):
        return _facts_by_pushdown(spark, path)
    tasks = max(1, -(-len(files) // FILES_PER_TASK))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["file"]:
                rows = pd.DataFrame(list(_footer_rows(uri)), columns=["column_name", "n_rows", "nulls", "low", "high"])
                # A nested column has several leaves; it is one column without a count.
                rows = rows.drop_duplicates("column_name")
                yield rows.astype({"n_rows": "Int64", "nulls": "Int64", "low": "Int64", "high": "Int64"})

    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(tasks)
    leaves = listed.mapInPandas(read, _FOOTER)
    untold = F.max(F.col("nulls").isNull())
    # Files that hold only NULLs have no bounds and need none.
    unbounded = F.max(F.col("low").isNull() & ~F.col("nulls").eqNullSafe(F.col("n_rows")))
    facts = leaves.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.when(~untold, F.sum(F.col("n_rows") - F.col("nulls"))).alias("non_null_rows"),
        F.when(~unbounded, F.min("low")).alias("low"), F.when(~unbounded, F.max("high")).alias("high"),
    )
    # As many rows as the table has columns, so one window over them is small.
    whole = F.max(F.when(F.col("column_name").isNull(), F.col("n_rows"))).over(Window.partitionBy(F.lit(0)))
    counted = facts.withColumn("row_count", whole).where(F.col("column_name").isNotNull())
    return counted.select("column_name", "row_count", "non_null_rows", "low", "high")


def _facts_by_pushdown(spark: SparkSession, path: str) -> DataFrame:
    """``footer_facts`` by aggregates that Spark answers from footers, on any store it can read.

    Only whole numbers and dates have bounds here. The settings it needs hold in a
    session of its own. What the footers of some file do not tell is untold.
    """
    side = spark.newSession()
    side.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    listed = [s for s in side.conf.get("spark.sql.sources.useV1SourceList").split(",") if s != "parquet"]
    side.conf.set("spark.sql.sources.useV1SourceList", ",".join(listed))
    df = side.read.parquet(path)

    def told(*aggregates: Column) -> Row | None:
        try:
            return df.agg(*aggregates).first()
        except Py4JJavaError as error:
            if "spark.sql.parquet.aggregatePushdown" not in str(error):
                raise
            return None  # a file keeps no such statistics

    def ends(name: str) -> list[Column]:
        return [F.min(quoted(name)).alias(f"low {name}"), F.max(quoted(name)).alias(f"high {name}")]

    flat = [f.name for f in df.schema.fields if not isinstance(f.dataType, _NESTED)]
    total = told(F.count(F.lit(1)))[0]
    filled = dict(zip(flat, told(*[F.count(quoted(c)) for c in flat]) or [None] * len(flat))) if flat else {}
    bounded = [f.name for f in df.schema.fields if isinstance(f.dataType, (*_WHOLE, T.DateType)) and filled[f.name]]
    # All at once, or one by one where a file of NULLs only has no bounds for some column.
    at_once = told(*[e for c in bounded for e in ends(c)]) if bounded else None
    bounds = [at_once] if at_once else [told(*ends(c)) for c in bounded]
    found = {key: _ordinal(value) for row in bounds if row for key, value in row.asDict().items()}
    facts = [(c, total, filled.get(c), found.get(f"low {c}"), found.get(f"high {c}")) for c in df.columns]
    return spark.createDataFrame(facts, _FACTS)


def list_columns_by_footers(spark: SparkSession, path: str) -> DataFrame:
    """``operators.columns.list_columns`` of a Parquet table, by its footers where they tell."""
    df = spark.read.parquet(path)
    facts = {r["column_name"]: r for r in footer_facts(spark, path).collect()}  # one row a column
    untold = [f.name for f in df.schema.fields if f.name not in facts or facts[f.name]["non_null_rows"] is None]
    scanned = df.agg(F.count(F.lit(1)), *[F.count(quoted(c)) for c in untold]).first() if untold else [None]
    counted = dict(zip(untold, scanned[1:]))
    rows = []
    for i, field in enumerate(df.schema.fields, start=1):
        known = facts.get(field.name)
        total = scanned[0] if known is None else known["row_count"]
        filled = counted[field.name] if field.name in counted else known["non_null_rows"]
        rows.append((i, field.name, field.dataType.simpleString(), checksum_class(field.dataType), total, filled))
    schema = "position int, column_name string, data_type string, checksum_class string, row_count long, non_null_rows long"
    return spark.createDataFrame(rows, schema)


def max_key_by_footers(spark: SparkSession, path: str, key: str) -> DataFrame:
    """``max_key`` of a whole-number column, by the footers; by a scan where they do not tell."""
    df = spark.read.parquet(path)
    if isinstance(df.schema[key].dataType, _WHOLE):
        found = footer_facts(spark, path).where(F.col("column_name") == key).first()
        if found is not None and found["high"] is not None:
            return spark.range(1).select(F.lit(found["high"]).cast(df.schema[key].dataType).alias("max_key"))
    return df.agg(F.max(key).alias("max_key"))


def table_counts_by_footers(spark: SparkSession, path: str, table_name: str) -> DataFrame:
    """``operators.checksum.table_counts`` of a Parquet table; no data page is read."""
    found = footer_facts(spark, path).agg(F.coalesce(F.max("row_count"), F.lit(0).cast("long")).alias("row_count"))
    return found.select(F.lit(table_name).alias("table_name"), "row_count")


def schema_diff_by_footers(spark: SparkSession, source: str, target: str) -> DataFrame:
    """``operators.columns.schema_diff`` of two Parquet tables, given by their paths."""
    return side_by_side(_described(spark, source, "source"), _described(spark, target, "target"))


def _described(spark: SparkSession, path: str, side: str) -> DataFrame:
    same_name = Window.partitionBy(F.lower("column_name")).orderBy("position")
    return list_columns_by_footers(spark, path).select(
        F.lower("column_name").alias("column_name"), F.row_number().over(same_name).alias("occurrence"),
        F.col("data_type").alias(f"{side}_type"), F.col("non_null_rows").alias(f"{side}_non_null"),
    )
