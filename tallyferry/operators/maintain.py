"""Changing a target: deleting, replacing and emptying, without a transactional format.

A target is a parquet folder. Tables with a date column are partitioned by day
(``day_part``), so that replacing a window rewrites only the days it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyferry.functions.predicates import date_window, outside
from tallyferry.session import child_names, clear_folder, hadoop_path, materialise, path_exists
from tallyferry.specs import Window

DAY = "day_part"


def delete_rows(df: DataFrame, condition: Column) -> DataFrame:
    """What a SQL DELETE leaves: rows where the condition is FALSE or NULL."""
    return df.where(outside(condition))


def replace_rows(target: DataFrame, condition: Column, fresh: DataFrame) -> DataFrame:
    """The target with the rows that meet the condition replaced by ``fresh``."""
    return delete_rows(target, condition).unionByName(fresh.select(*target.columns))


def write_days(df: DataFrame, path: str, date_col: str, mode: str = "errorifexists") -> None:
    """Write a target partitioned by the day of ``date_col``."""
    _by_day(df, date_col).write.mode(mode).partitionBy(DAY).parquet(path)


def _by_day(df: DataFrame, date_col: str) -> DataFrame:
    # Rebalancing groups days into few files and splits a hot day over tasks (AQE).
    return df.withColumn(DAY, F.col(date_col).cast("date")).hint("rebalance", DAY)


def read_target(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A target as its own columns, day partition left out. Empty folder: no rows."""
    if not has_data(spark, path):
        return spark.createDataFrame([], schema)
    full = schema
    if is_by_day(spark, path):
        full = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    return spark.read.schema(full).parquet(path).select(*schema.names)


def is_by_day(spark: SparkSession, path: str) -> bool:
    return any(n.startswith(f"{DAY}=") for n in child_names(spark, path))


def has_data(spark: SparkSession, path: str) -> bool:
    return any(not n.startswith(("_", ".")) for n in child_names(spark, path))


def replace_window(
    spark: SparkSession, path: str, fresh: DataFrame, date_col: str, window: Window
) -> None:
    """Replace ``[start, end)`` of a day-partitioned target; running it twice changes nothing.

    Only the days of the window are written. Rows of a partly covered first or
    last day that lie outside the window are read before and written back.
    """
    schema = T.StructType([f for f in fresh.schema.fields if f.name != DAY])
    fresh = fresh.select(*schema.names)
    fresh = fresh.where(F.coalesce(date_window(fresh, date_col, window), F.lit(False)))
    if has_data(spark, path):
        if not is_by_day(spark, path):
            raise ValueError(f"{path} is not partitioned by day: write it with write_days")
        stored = spark.read.schema(
            T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
        ).parquet(path)
        edges = [day[:10] for day in (window.start, window.end) if day and day[11:] != "00:00:00"]
        if edges:
            on_edge = F.col(DAY).isin([F.lit(d).cast("date") for d in edges])
            kept = delete_rows(stored.where(on_edge), date_window(stored, date_col, window))
            # Out of the folder before its days are overwritten.
            fresh = fresh.unionByName(materialise(kept.select(*schema.names), "kept"))
    # At most the days of the window.
    written = {
        str(r[0]) for r in fresh.select(F.col(date_col).cast("date")).distinct().collect()
    }
    (
        _by_day(fresh, date_col).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )
    _drop_days(spark, path, window, written)


def _drop_days(spark: SparkSession, path: str, window: Window, keep: set[str]) -> None:
    """Remove the window's day folders that received no rows (metadata only)."""
    first, last = (window.start or "")[:10], window.end
    for name in child_names(spark, path):
        day = name.removeprefix(f"{DAY}=")
        if not name.startswith(f"{DAY}=") or day.startswith("__") or day in keep:
            continue
        starts_before_end = last is None or f"{day} 00:00:00" < last
        if day >= first and starts_before_end:
            clear_folder(spark, f"{path}/{name}")


def replace_days(spark: SparkSession, path: str, fresh: DataFrame, date_col: str, days: list[str]) -> None:
    """Replace whole days (``YYYY-MM-DD``) of a day-partitioned target; other rows of ``fresh`` are left out."""
    day = F.col(date_col).cast("date")
    fresh = fresh.where(day.isin([F.lit(d).cast("date") for d in days]))
    written = {str(r[0]) for r in fresh.select(day).distinct().collect()}
    _by_day(fresh, date_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)
    for empty in set(days) - written:
        clear_folder(spark, f"{path}/{DAY}={empty}")


def publish_files(spark: SparkSession, staged: str, target: str, name: str) -> None:
    """Move the files of a staged table, folders kept, into a target under names that begin with ``name``.

    Files that an earlier attempt of the same name moved are taken out first, so
    running it again replaces them. Only names are touched, not data.
    """
    mark = f"{target}/_batches/{name}"
    _, fs = hadoop_path(spark, target)
    if path_exists(spark, mark):
        for folder, file in data_files(spark, target):
            if file.startswith(f"{name}-"):
                clear_folder(spark, f"{target}/{folder}{file}")
    else:
        # Set before the first file moves: whoever finds it knows that some may have.
        fs.mkdirs(hadoop_path(spark, mark)[0])
    for folder, file in data_files(spark, staged):
        fs.mkdirs(hadoop_path(spark, f"{target}/{folder}")[0])
        moved = fs.rename(
            hadoop_path(spark, f"{staged}/{folder}{file}")[0], hadoop_path(spark, f"{target}/{folder}{name}-{file}")[0]
        )
        if not moved:
            raise OSError(f"{staged}/{folder}{file} could not be moved to {target}")
    clear_folder(spark, staged)


def data_files(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(folder with a slash, or nothing; file) of the Parquet files at most one folder below ``path``."""
    found = []
    for name in child_names(spark, path):
        if name.startswith(("_", ".")):
            continue
        if name.endswith(".parquet"):
            found.append(("", name))
        else:
            found += [(f"{name}/", file) for file in child_names(spark, f"{path}/{name}") if file.endswith(".parquet") and file[0] not in "._"]
    return found


def append_target(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Append to a catalog table, columns matched by name."""
    names = spark.table(table).columns
    rows.select(*names).write.mode("append").saveAsTable(table)


def append_path(
    rows: DataFrame, path: str, schema: T.StructType, date_col: str | None = None
) -> None:
    """Append to a folder target, columns matched by name.

    A target by days gets its rows by days too: files beside the day folders
    would never be read. ``date_col`` is needed then.
    """
    rows = rows.select(*schema.names)
    if is_by_day(rows.sparkSession, path):
        if date_col is None:
            raise ValueError(f"{path} is partitioned by day: give its date column to append")
        write_days(rows, path, date_col, "append")
    else:
        rows.write.mode("append").parquet(path)


def truncate_path(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Empty a folder target. A target by days loses its day folders; any other
    keeps its schema in one empty file."""
    if is_by_day(spark, path):
        clear_folder(spark, path)
    else:
        spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)


def truncate_tables(spark: SparkSession, tables: list[str]) -> None:
    for table in tables:
        spark.sql(f"TRUNCATE TABLE {table}")


def create_if_absent(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """CREATE TABLE IF NOT EXISTS ... USING parquet."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")


def drop_if_present(spark: SparkSession, tables: list[str]) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
