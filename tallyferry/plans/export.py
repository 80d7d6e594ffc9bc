"""The export job: choose the slice, decide on chunks, write delimited files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyferry.functions.predicates import date_window
from tallyferry.operators.chunking import assign_chunks, plan_chunks, spread_by_chunk
from tallyferry.operators.select import date_floor, sample_slice, sort_desc
from tallyferry.operators.sizing import chunk_rows_for, stored_mb
from tallyferry.session import clear_folder
from tallyferry.sources.delimited import CHUNK, write_delimited
from tallyferry.specs import Settings, TableSpec, Window, check_mode, moves_in_one_piece

# A chunk is a range of keys, not one task's work: about this much of it per task.
TASK_MB = 256


@dataclass(frozen=True)
class Exported:
    """What an export wrote: its folder, the slice it covers and its number of chunks."""

    spec: TableSpec
    path: str
    condition: Column
    chunks: int


def export_table(
    df: DataFrame,
    spec: TableSpec,
    out: str,
    sample_size: int = 0,
    window: Window | None = None,
    settings: Settings = Settings(),
) -> Exported:
    """Write one table's slice to ``<out>/<table>/chunk_id=N/``.

    Three modes: the newest ``sample_size`` rows by the partition column, a date
    window, or the whole table. ``condition`` of the result is the same slice
    for later checks. A table without the needed column is moved whole.
    """
    check_mode(sample_size, window)
    path = f"{out.rstrip('/')}/{spec.name}"
    if sample_size > 0:
        if spec.partition_col is None:
            return _write_one(df, spec, path, F.lit(True), settings)
        if spec.sample_window:
            condition = date_window(df, spec.date_col, spec.sample_window)
        else:
            floor = None
            if spec.sample_floor and spec.date_col:
                floor = date_floor(df, spec.partition_col, spec.date_col, sample_size)
            _, _, condition = sample_slice(df, spec.partition_col, sample_size, spec.date_col, floor)
        ordered = sort_desc(df.where(condition), spec.partition_col)
        return _write_one(ordered, spec, path, condition, settings)
    condition = date_window(df, spec.date_col, window)
    moved = df.where(condition) if window and spec.date_col else df
    weeks = window.weeks if window and spec.date_col else -1.0
    size_mb = stored_mb(df)
    if spec.partition_col is None or moves_in_one_piece(int(size_mb), weeks, settings):
        return _write_one(moved, spec, path, condition, settings)
    rows = chunk_rows_for(round(size_mb, 1), df.count(), settings.chunk_mb)
    plan = plan_chunks(moved, spec.partition_col, rows)
    tasks = max(1, round(settings.chunk_mb / TASK_MB))
    chunked = spread_by_chunk(assign_chunks(moved, plan), plan, tasks)
    write_delimited(chunked, path, settings, chunked=True, max_rows=rows)
    return Exported(spec, path, condition, plan.chunks)


def _write_one(df, spec, path, condition, settings) -> Exported:
    # One chunk, still written by as many tasks as read it. Straight into its folder:
    # a partitioned write would sort by chunk and lose the order of the rows.
    clear_folder(df.sparkSession, path)
    write_delimited(df, f"{path}/{CHUNK}=0", settings)
    return Exported(spec, path, condition, 1)


def export_tables(
    spark: SparkSession,
    read,
    specs,
    out: str,
    sample_size: int = 0,
    window: Window | None = None,
    settings: Settings = Settings(),
) -> list[Exported]:
    """Export every table of a job; ``read(spec)`` gives the source table."""
    check_mode(sample_size, window)
    return [export_table(read(s), s, out, sample_size, window, settings) for s in specs]
