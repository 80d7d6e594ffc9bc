"""Day-by-day history loads as few jobs, with counts and checks per day, that go on where a run stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyferry.functions.predicates import date_window
from tallyferry.operators.maintain import read_target, replace_days, replace_window
from tallyferry.operators.reconcile import FAILURE, reconcile, stamp_report
from tallyferry.session import materialise, path_exists
from tallyferry.specs import TableSpec, Window


def day_windows(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` until ``end`` (exclusive): ``from_date``, ``to_date``."""
    first, last = F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1)
    days = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))
    return spark.range(1).select(F.explode(days).alias("from_date")).select(
        "from_date", F.date_add("from_date", 1).alias("to_date")
    )


def rows_per_day(df: DataFrame, date_col: str, start: str, end: str) -> DataFrame:
    """Every window of the range with its row count, days without rows included."""
    window = Window(f"{start} 00:00:00", f"{end} 00:00:00")
    counts = (
        df.where(date_window(df, date_col, window))
        .groupBy(F.col(date_col).cast("date").alias("from_date"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    windows = day_windows(df.sparkSession, start, end)
    return windows.join(counts, "from_date", "left").select(
        "from_date", "to_date", F.coalesce("row_count", F.lit(0)).alias("row_count")
    )


#: Days that one job loads and checks before their states are kept.
DAYS_PER_STEP = 31
LOADED, CHECKED, FAILED = "loaded", "checked", "failed"
STATE = "run_day date, status string, row_count bigint, last_id string, run_ts timestamp_ntz"


def backfill(
    spark: SparkSession,
    source: DataFrame,
    spec: TableSpec,
    target: str,
    start: str,
    end: str,
    state: str | None = None,
    run_ts: str | None = None,
    days_per_step: int = DAYS_PER_STEP,
) -> DataFrame:
    """Load all days of ``[start, end)`` and report on each day that was loaded.

    The serial day loop is not needed: days are partitions of the target, so one
    job replaces many, and a rerun of any sub-range is idempotent.

    With a ``state`` folder (and ``run_ts``, the time of this run) only days that are not yet
    loaded and checked are written, ``days_per_step`` at a time. Each step keeps the days'
    states, row counts and highest ``partition_col``, so the next run goes on where a
    broken one stopped.
    """
    window = Window(f"{start} 00:00:00", f"{end} 00:00:00")
    if state is None:
        replace_window(spark, target, source, spec.date_col, window)
        return report_by_day(source, read_target(spark, target, source.schema), spec, window)
    if run_ts is None:
        raise ValueError("a run that keeps states needs its time: give run_ts")
    days = open_days(spark, state, start, end)
    for first in range(0, len(days), days_per_step):
        step = days[first : first + days_per_step]
        replace_days(spark, target, source, spec.date_col, step)
        save_states(_day_rows(source, spec, step).withColumn("status", F.lit(LOADED)), state, run_ts)
        report = _report_days(source, read_target(spark, target, source.schema), spec, step)
        failed = materialise(report.where(F.col("status") == FAILURE).select("run_day").distinct(), "failed-days")
        judged = _day_rows(source, spec, step).join(failed.withColumn("bad", F.lit(True)), "run_day", "left")
        status = F.when(F.col("bad"), FAILED).otherwise(CHECKED)
        save_states(judged.withColumn("status", status), state, run_ts)
    return _report_days(source, read_target(spark, target, source.schema), spec, days)


def day_states(spark: SparkSession, state: str) -> DataFrame:
    """The last state of each day: run_day, status, row_count, last_id, run_ts."""
    if not path_exists(spark, state):
        return spark.createDataFrame([], STATE)
    # Of one run, the verdict comes after the load.
    order = F.struct("run_ts", F.col("status") != LOADED)
    names = ["status", "row_count", "last_id", "run_ts"]
    latest = spark.read.schema(STATE).parquet(state).groupBy("run_day").agg(F.max_by(F.struct(*names), order).alias("s"))
    return latest.select("run_day", *[f"s.{n}" for n in names])


def open_days(spark: SparkSession, state: str, start: str, end: str) -> list[str]:
    """Days of ``[start, end)`` that no run has loaded and checked. At most the days of the range."""
    done = day_states(spark, state).where(F.col("status") == CHECKED).select(F.col("run_day").alias("from_date"))
    left = day_windows(spark, start, end).join(done, "from_date", "left_anti")
    return sorted(str(r["from_date"]) for r in left.collect())


def save_states(states: DataFrame, state: str, run_ts: str) -> None:
    """Append the states of one step."""
    names = [f.split()[0] for f in STATE.split(", ")]
    stamp_report(states, run_ts).select(*names).coalesce(1).write.mode("append").parquet(state)


def _of_days(df: DataFrame, spec: TableSpec, days: list[str]) -> DataFrame:
    day = F.col(spec.date_col).cast("date")
    return df.where(day.isin([F.lit(d).cast("date") for d in days])).withColumn("run_day", day)


def _day_rows(source: DataFrame, spec: TableSpec, days: list[str]) -> DataFrame:
    """Each day with its rows and highest key, days without rows included."""
    last = F.max(spec.partition_col).cast("string") if spec.partition_col else F.lit(None).cast("string")
    counts = _of_days(source, spec, days).groupBy("run_day").agg(F.count(F.lit(1)).alias("row_count"), last.alias("last_id"))
    spark = source.sparkSession
    asked = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("run_day"))
    return asked.join(F.broadcast(counts), "run_day", "left").fillna(0, ["row_count"])


def _report_days(source: DataFrame, target: DataFrame, spec: TableSpec, days: list[str]) -> DataFrame:
    return reconcile(_of_days(source, spec, days), _of_days(target, spec, days), spec.name, by=["run_day"], fingerprint=None)


def report_by_day(
    source: DataFrame, target: DataFrame, spec: TableSpec, window: Window
) -> DataFrame:
    """Reconcile every day of a window in one pass over each side."""

    def daily(df: DataFrame) -> DataFrame:
        day = F.col(spec.date_col).cast("date")
        return df.where(date_window(df, spec.date_col, window)).withColumn("run_day", day)

    return reconcile(daily(source), daily(target), spec.name, by=["run_day"], fingerprint=None)


def bookmark(df: DataFrame, table_name: str, column: str) -> DataFrame:
    """High-water mark of one table as text: ``table_name``, ``last_id``."""
    return df.agg(F.max(column).cast("string").alias("last_id")).select(
        F.lit(table_name).alias("table_name"), "last_id"
    )


def save_bookmarks(marks: DataFrame, path: str, run_ts: str) -> None:
    """Append the marks of one run to a bookmark table."""
    stamp_report(marks, run_ts).write.mode("append").parquet(path)


def latest_bookmarks(history: DataFrame) -> DataFrame:
    """The last mark of each table."""
    return history.groupBy("table_name").agg(F.max_by("last_id", "run_ts").alias("last_id"))
