"""Loading many files a bounded number at a time, as a file stream run to its end."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyferry.operators.intervals import between_cuts
from tallyferry.operators.maintain import has_data, is_by_day, publish_files, write_days
from tallyferry.session import child_names, clear_folder, path_exists, scratch_path
from tallyferry.sources.delimited import RAW, Loaded, conform, parse_options, read_delimited, write_counting_bad
from tallyferry.sources.traced import Traced, lines_below, stage_traced
from tallyferry.specs import MissingInput, Settings, TooManyBadRows

BATCH = "load_batch"
#: What Spark tells about a file; its content is not read unless asked for.
FILE = "path string, modificationTime timestamp, length bigint, content binary"
#: Batches that one trigger of the file stream takes, as its cost hardly depends on the files.
#: Folder numbers are multiples of it, so it must not change while progress folders are in use.
WAVE = 64


def load_in_batches(
    spark: SparkSession,
    path: str,
    header: list[str],
    schema: T.StructType,
    target: str,
    settings: Settings,
    progress: str | None = None,
) -> int:
    """Load every file below ``path``, ``files_per_batch`` at a time; returns the batches run.

    ``header`` names the columns in file order. Each batch has a folder of its
    own (``load_batch=N``), so a batch that runs again after a failure replaces
    what it wrote. Up to ``WAVE`` batches are written by one job; numbers follow the order of
    batches and may leave gaps. ``progress`` keeps the stream's checkpoint: given again, only
    files that are new since then are loaded.
    """
    if not path_exists(spark, path):
        raise MissingInput(f"no files to load: {path} does not exist")
    # The stream knows files by name only; a wave's files are read by one job.
    reader = spark.readStream.option("maxFilesPerTrigger", settings.files_per_batch * WAVE)
    names = reader.schema(FILE).format("binaryFile").option("recursiveFileLookup", "true").load(path)

    def write_wave(found: DataFrame, number: int) -> None:
        # At most ``files_per_batch`` times ``WAVE`` names.
        files = sorted((r["name"], r["path"]) for r in found.collect())
        if files:
            loaded, batches = read_wave(spark, files, header, schema, settings)
            store_wave(loaded, target, number, batches, settings)

    _run(names.select(F.col("_metadata.file_path").alias("name"), "path"), write_wave, progress or scratch_path(spark, "progress"))
    return sum(1 for name in child_names(spark, target) if name.startswith(f"{BATCH}="))


def run_batches(
    spark: SparkSession,
    path: str,
    header: list[str],
    schema: T.StructType,
    settings: Settings,
    progress: str,
    commit: Callable[[Loaded | Traced, int], None],
    traced: bool = False,
) -> None:
    """Give the files that ``progress`` does not know to ``commit``, some at a time, with the batch's number.

    A batch that did not end is given again with the same files and the same number.
    With ``traced``, bad rows know their file and line.
    """
    if not path_exists(spark, path):
        raise MissingInput(f"no files to load: {path} does not exist")
    text = T.StructType(
        [T.StructField(n, T.StringType()) for n in header] + [T.StructField(RAW, T.StringType())]
    )
    reader = spark.readStream.option("maxFilesPerTrigger", settings.files_per_batch)
    if traced:
        stream = lines_below(reader, path)
    else:
        stream = reader.schema(text).options(**parse_options(settings)).option("recursiveFileLookup", "true").csv(path)

    def write_batch(batch: DataFrame, number: int) -> None:
        if traced:
            commit(stage_traced(batch, header, schema, settings), number)
            return
        commit(conform(batch, schema, settings.separator, escaped=settings.escape_breaks), number)

    _run(stream, write_batch, progress)


def _run(stream: DataFrame, write: Callable[[DataFrame, int], None], progress: str) -> None:
    """Give a stream's batches to ``write`` until what is there now has been read."""
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()


def read_wave(
    spark: SparkSession, files: list[tuple[str, str]], header: list[str], schema: T.StructType, settings: Settings
) -> tuple[Loaded, int]:
    """The rows of sorted (name, path) files with their batch's number inside the wave as ``BATCH``; how many batches."""
    size = max(settings.files_per_batch, -(-len(files) // WAVE))
    # Paths are given as patterns; these characters stand for themselves.
    paths = [re.sub(r"([\\{}\[\]*?])", r"\\\1", path) for _, path in files]
    text = read_delimited(spark, paths, settings, columns=header, checked=False)
    # A batch is a range of file names, so every row falls in exactly one.
    place = between_cuts(F.col("_metadata.file_path"), [name for name, _ in files[size::size]])
    numbered = text.select("*", place.alias(BATCH))
    loaded = conform(numbered, schema, settings.separator, escaped=settings.escape_breaks, carried=(BATCH,))
    return loaded, -(-len(files) // size)


def store_wave(loaded: Loaded, target: str, wave: int, batches: int, settings: Settings) -> None:
    """Write the good rows of a wave's batches in one job, a folder for each.

    With too many bad rows in a batch, its folder and those behind it are removed again.
    """
    spark = loaded.rows.sparkSession
    folders = [f"{target}/{BATCH}={wave * WAVE + i}" for i in range(WAVE)]
    for folder in folders:
        clear_folder(spark, folder)
    moved = Loaded(loaded.rows.withColumn(BATCH, F.col(BATCH) + F.lit(wave * WAVE)), loaded.schema)
    if write_counting_bad(moved, target, BATCH) > settings.max_bad_rows:
        # One batch's budget: they are told apart only when all together exceed it.
        counted = loaded.bad(BATCH).groupBy(BATCH).count().where(F.col("count") > settings.max_bad_rows)
        if first := counted.orderBy(BATCH).first():
            for folder in folders[first[BATCH]:]:
                clear_folder(spark, folder)
            raise TooManyBadRows(f"{first['count']} bad rows, {settings.max_bad_rows} allowed, for {folders[first[BATCH]]}")
    for folder in folders[:batches]:
        if not path_exists(spark, folder):
            spark.createDataFrame([], loaded.schema).write.parquet(folder)


def store_batch(loaded: Loaded, folder: str, settings: Settings) -> None:
    """Write one batch's good rows, parsing its files once.

    The bad rows are counted on the way; with too many the folder is removed again.
    """
    bad = write_counting_bad(loaded, folder)
    if bad > settings.max_bad_rows:
        clear_folder(loaded.rows.sparkSession, folder)
        raise TooManyBadRows(f"{bad} bad rows, {settings.max_bad_rows} allowed, for {folder}")


def load_into_target(
    spark: SparkSession,
    path: str,
    header: list[str],
    schema: T.StructType,
    target: str,
    settings: Settings,
    progress: str,
    date_col: str | None = None,
    quarantine: str | None = None,
) -> None:
    """Append files to a folder target some at a time; each batch's rows are in it exactly once.

    The files that a batch adds bear its number and its ``progress`` folder. A batch that
    runs again, because the run before broke, first takes out what it had added.
    """
    stream = hashlib.md5(progress.rstrip("/").encode()).hexdigest()[:12]
    by_day = date_col is not None and (is_by_day(spark, target) or not has_data(spark, target))

    def commit(loaded: Loaded | Traced, number: int) -> None:
        name = f"batch-{stream}-{number}"
        stored, shaped = scratch_path(spark, "batch"), scratch_path(spark, "batch-files")
        if isinstance(loaded, Traced):
            loaded.bad().write.mode("overwrite").parquet(f"{quarantine}/{name}")
            if (bad := loaded.count_bad()) > settings.max_bad_rows:
                raise TooManyBadRows(f"{bad} bad rows, {settings.max_bad_rows} allowed, in {name}")
            rows = loaded.good()
        else:
            store_batch(loaded, stored, settings)
            rows = spark.read.schema(schema).parquet(stored)
        if by_day:
            write_days(rows, shaped, date_col)
        else:
            rows.write.parquet(shaped)
        publish_files(spark, shaped, target, name)
        clear_folder(spark, stored)

    run_batches(spark, path, header, schema, settings, progress, commit, traced=quarantine is not None)
