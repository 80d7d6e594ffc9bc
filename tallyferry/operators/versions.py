"""A target by days whose changes become visible all at once.

Rows lie in folders that are never changed after they were written: one per write and day.
A manifest lists, for each day, the folder that holds it. A change writes new folders,
then a manifest with the next number under another name, and renames it: that one
step is the commit. Readers take the highest number and see the state before or after it,
never between; a writer that dies before leaves folders that no manifest names. Of two
writers that start from the same state one finds its number taken and fails.

Old states are kept, so that running readers can end, until ``release_versions``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyferry.functions.predicates import date_window
from tallyferry.operators.maintain import DAY, delete_rows, write_days
from tallyferry.session import child_names, clear_folder, hadoop_path, path_exists
from tallyferry.specs import MoveError, Window

_DATA, _MANIFESTS = "data", "_manifests"


class WriteConflict(MoveError):
    """Another writer changed the target since this one read its state."""


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the target's states that can still be read, in order."""
    return sorted(int(n) for n in child_names(spark, f"{path}/{_MANIFESTS}") if n.isdigit())


def _state(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict[str, str]]:
    """A state's number and its folder per day; number 0 without days where nothing was written."""
    known = versions(spark, path)
    if version is None:
        version = known[-1] if known else 0
    if version == 0:
        return 0, {}
    if version not in known:
        raise ValueError(f"{path} has no state {version}: it was released or never written")
    lines = spark.read.text(f"{path}/{_MANIFESTS}/{version:012d}", wholetext=True).collect()
    return version, json.loads(lines[0][0])


def _commit(spark: SparkSession, path: str, number: int, days: dict[str, str]) -> None:
    """Make a state visible: written under another name, then renamed."""
    folder = f"{path}/{_MANIFESTS}"
    hidden, fs = hadoop_path(spark, f"{folder}/_{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    try:
        out.write(bytearray(json.dumps(days, sort_keys=True).encode()))
    finally:
        out.close()
    final, _ = hadoop_path(spark, f"{folder}/{number:012d}")
    if fs.exists(final) or not fs.rename(hidden, final):
        fs.delete(hidden, False)
        raise WriteConflict(f"{path}: state {number} was written by another run")


def read_version(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The target's rows as of its last state, or of a kept earlier one. Nothing written: no rows."""
    _, days = _state(spark, path, version)
    folders = [f"{path}/{_DATA}/{folder}/{DAY}={day}" for day, folder in sorted(days.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def replace_window_at_once(spark: SparkSession, path: str, fresh: DataFrame, date_col: str, window: Window) -> int:
    """Replace ``[start, end)`` and return the new state's number; running it twice changes no row.

    Only days of the window are written. Rows of its first and last day outside of it
    are copied from the state before.
    """
    schema = T.StructType([f for f in fresh.schema.fields if f.name != DAY])
    fresh = fresh.select(*schema.names)
    fresh = fresh.where(F.coalesce(date_window(fresh, date_col, window), F.lit(False)))
    number, days = _state(spark, path)
    edges = [end[:10] for end in (window.start, window.end) if end and end[11:] != "00:00:00" and end[:10] in days]
    if edges:
        parts = [f"{path}/{_DATA}/{days[d]}/{DAY}={d}" for d in sorted(set(edges))]
        stored = spark.read.schema(schema).parquet(*parts)
        fresh = fresh.unionByName(delete_rows(stored, date_window(stored, date_col, window)))
    folder = uuid.uuid4().hex
    write_days(fresh, f"{path}/{_DATA}/{folder}", date_col)
    written = [n.removeprefix(f"{DAY}=") for n in child_names(spark, f"{path}/{_DATA}/{folder}") if n.startswith(f"{DAY}=")]
    kept = {day: old for day, old in days.items() if not _touched(day, window)}
    _commit(spark, path, number + 1, kept | {day: folder for day in written})
    return number + 1


def _touched(day: str, window: Window) -> bool:
    """Whether a day has a part in the window; rows without a date never have."""
    if day.startswith("__"):
        return False
    after_start = window.start is None or day >= window.start[:10]
    return after_start and (window.end is None or f"{day} 00:00:00" < window.end)


def release_versions(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Drop all states but the last ``keep``, and folders that none of those names; returns how many folders went.

    Also what broken writers left goes, so no other writer may run meanwhile.
    """
    known = versions(spark, path)
    named = {folder for v in known[-keep:] for folder in _state(spark, path, v)[1].values()}
    for version in known[:-keep]:
        clear_folder(spark, f"{path}/{_MANIFESTS}/{version:012d}")
    gone = [n for n in child_names(spark, f"{path}/{_DATA}") if n not in named] if path_exists(spark, f"{path}/{_DATA}") else []
    for folder in gone:
        clear_folder(spark, f"{path}/{_DATA}/{folder}")
    return len(gone)
