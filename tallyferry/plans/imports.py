"""The import job: load an export's files into a target, then prove the copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tallyferry.operators.maintain import (
    append_path, read_target, replace_window, truncate_path,
)
from tallyferry.plans.audit import reconcile_tables
from tallyferry.session import clear_folder, file_count, path_exists, scratch_path
from tallyferry.sources.delimited import Loaded, header_of, load_delimited, write_counting_bad
from tallyferry.sources.traced import Traced, load_traced
from tallyferry.specs import MissingInput, Settings, TableSpec, TooManyBadRows, Window
from tallyferry.streaming.file_batches import load_into_target


def stage_good_rows(
    loaded: Loaded | Traced, settings: Settings, quarantine: str | None = None
) -> DataFrame:
    """Parse the files once into a scratch table while counting the bad rows.

    The budget is checked before anything reaches the target. Bad rows, if there
    are any, are added to the ``quarantine`` folder with the reason, and with their
    file and line if they were traced.
    """
    if isinstance(loaded, Traced):
        bad = loaded.count_bad()
        if bad and quarantine:
            loaded.bad().write.mode("append").parquet(quarantine)
        if bad > settings.max_bad_rows:
            raise TooManyBadRows(f"{bad} bad rows, {settings.max_bad_rows} allowed")
        return loaded.good()
    spark = loaded.rows.sparkSession
    path = scratch_path(spark, "loaded")
    bad = write_counting_bad(loaded, path)
    if bad and quarantine:
        loaded.bad().write.mode("append").parquet(quarantine)
    if bad > settings.max_bad_rows:
        clear_folder(spark, path)
        raise TooManyBadRows(f"{bad} bad rows, {settings.max_bad_rows} allowed")
    return spark.read.schema(loaded.schema).parquet(path)


def import_table(
    spark: SparkSession,
    spec: TableSpec,
    schema: T.StructType,
    files: str,
    target: str,
    window: Window | None = None,
    settings: Settings = Settings(),
    multi_line: bool = False,
    quarantine: str | None = None,
    progress: str | None = None,
) -> DataFrame:
    """Load ``<files>/<table>`` into the folder target and return the target.

    With a window and a date column the window's rows are replaced, so a second
    run changes nothing; otherwise the rows are appended. More than ``files_per_batch``
    files are loaded that many at a time, and so are any when ``progress`` is given:
    files that this folder knows are not appended again. The budget of bad rows is one
    batch's then, and its quarantine a folder below ``quarantine``. Refused lines are kept
    there with their file and line number, but for ``multi_line`` files.
    """
    source = f"{files.rstrip('/')}/{spec.name}"
    if not path_exists(spark, source):
        raise MissingInput(f"{spec.name}: no folder of files to load at {source}")
    replacing = bool(window and spec.date_col and settings.idempotent)
    if not multi_line and (progress or file_count(spark, source) > settings.files_per_batch):
        header = header_of(spark, source, settings)
        if not replacing:
            load_into_target(
                spark, source, header, schema, target, settings, progress or scratch_path(spark, "progress"), spec.date_col, quarantine
            )
            return read_target(spark, target, schema)
        # All files make up the window, so they are only staged in batches and known to no later run.
        path = scratch_path(spark, "staged")
        load_into_target(spark, source, header, schema, path, settings, scratch_path(spark, "progress"), None, quarantine)
        staged = read_target(spark, path, schema)
    else:
        if quarantine and not multi_line:
            loaded = load_traced(spark, source, schema, settings)
        else:
            loaded = load_delimited(spark, source, schema, settings, multi_line)
        staged = stage_good_rows(loaded, settings, quarantine)
    if replacing:
        replace_window(spark, target, staged, spec.date_col, window)
    else:
        append_path(staged, target, schema, spec.date_col)
    return read_target(spark, target, schema)


def import_tables(
    spark: SparkSession,
    read,
    specs,
    files: str,
    targets: str,
    window: Window | None = None,
    settings: Settings = Settings(),
    conditions: dict[str, Column] | None = None,
) -> DataFrame:
    """Import every table of a job, then report on all of them.

    ``read(spec)`` gives the source table; ``conditions`` the moved slice per
    table, applied to both sides of the comparison.
    """
    missing = [s.name for s in specs if not path_exists(spark, f"{files.rstrip('/')}/{s.name}")]
    if missing:
        raise MissingInput(f"no folder of files to load for {', '.join(missing)}")
    loaded = {
        spec.name: import_table(
            spark, spec, read(spec).schema, files, f"{targets.rstrip('/')}/{spec.target}", window,
            settings,
        )
        for spec in specs
    }
    return reconcile_tables(read, lambda spec: loaded[spec.name], specs, conditions)


def housekeep(spark: SparkSession, read, specs, targets: str) -> None:
    """Empty the target of every table of a job, whether or not it exists yet."""
    for spec in specs:
        path = f"{targets.rstrip('/')}/{spec.target}"
        if path_exists(spark, path):
            truncate_path(spark, path, read(spec).schema)
