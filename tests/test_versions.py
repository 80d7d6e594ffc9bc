"""Targets that change at once: killed writers, conflicts, old states."""

import os

import pytest
from conftest import values
from pyspark.sql import functions as F

from tallyferry.operators import maintain as M
from tallyferry.operators import versions as V
from tallyferry.specs import Window

ALL, PART = Window("2023-01-01 00:00:00"), Window("2024-01-05 06:00:00", "2024-01-08 00:00:00")


@pytest.fixture()
def target(spark, table, tmp_path):
    events, path = table("events"), str(tmp_path / "target")
    assert V.read_version(spark, path, events.schema).count() == 0
    assert V.replace_window_at_once(spark, path, events, "ts", ALL) == 1
    return events, path


def replaced(events, fresh):
    inside = "ts >= timestamp_ntz'2024-01-05 06:00:00' and ts < timestamp_ntz'2024-01-08'"
    return values(events.where(f"not ({inside})").unionByName(fresh.where(inside)))


def test_window_is_replaced_and_the_state_before_stays(spark, target):
    events, path = target
    fresh = events.withColumn("value", F.lit(-1.0)).where("event_id % 2 = 0")
    for number in (2, 3):
        assert V.replace_window_at_once(spark, path, fresh, "ts", PART) == number
        assert values(V.read_version(spark, path, events.schema)) == replaced(events, fresh)
    assert values(V.read_version(spark, path, events.schema, 1)) == values(events)
    # A day that gets no rows is gone.
    V.replace_window_at_once(spark, path, fresh.limit(0), "ts", Window("2024-01-06 00:00:00", "2024-01-07 00:00:00"))
    assert V.read_version(spark, path, events.schema).where("cast(ts as date) = date'2024-01-06'").count() == 0


@pytest.mark.parametrize("step", ["write_days", "_commit"])
def test_killed_writer_leaves_the_old_rows(spark, target, monkeypatch, step):
    events, path = target
    real = getattr(V, step)

    def killed(*args):
        if step == "write_days":
            real(*args)
        raise RuntimeError("killed")

    monkeypatch.setattr(V, step, killed)
    with pytest.raises(RuntimeError, match="killed"):
        V.replace_window_at_once(spark, path, events.limit(3), "ts", ALL)
    assert values(V.read_version(spark, path, events.schema)) == values(events)
    monkeypatch.setattr(V, step, real)
    assert len(os.listdir(f"{path}/data")) == 2 and V.release_versions(spark, path) == 1
    assert values(V.read_version(spark, path, events.schema)) == values(events)


def test_old_versions_are_released(spark, target):
    events, path = target
    before = V.read_version(spark, path, events.schema)
    V.replace_window_at_once(spark, path, events.limit(0), "ts", Window("2023-01-01 00:00:00", "2024-01-10 00:00:00"))
    V.replace_window_at_once(spark, path, events.withColumn("value", F.lit(0.0)), "ts", ALL)
    # The write without rows left a folder that no state names.
    assert V.release_versions(spark, path, keep=2) == 1 and V.versions(spark, path) == [2, 3]
    assert values(before) == values(events)
    assert V.release_versions(spark, path) == 1 and V.versions(spark, path) == [3]
    with pytest.raises(ValueError, match="no state 1"):
        V.read_version(spark, path, events.schema, 1)
    assert V.read_version(spark, path, events.schema).where("value <> 0").count() == 0


def test_second_writer_from_the_same_state_fails(spark, target, monkeypatch):
    events, path = target
    stale = V._state(spark, path)
    V.replace_window_at_once(spark, path, events.limit(5), "ts", PART)
    monkeypatch.setattr(V, "_state", lambda *a: stale)
    with pytest.raises(V.WriteConflict):
        V.replace_window_at_once(spark, path, events, "ts", PART)


def test_rows_without_a_date_stay(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, "2024-01-01 05:00:00")], "id long, t string").select("id", F.col("t").cast("timestamp_ntz").alias("t"))
    M.write_days(rows, str(tmp_path / "t" / "data" / "first"), "t")
    days = {"2024-01-01": "first", "__HIVE_DEFAULT_PARTITION__": "first"}
    V._commit(spark, str(tmp_path / "t"), 1, days)
    V.replace_window_at_once(spark, str(tmp_path / "t"), rows.limit(0), "t", Window(end="2025-01-01 00:00:00"))
    assert [r["id"] for r in V.read_version(spark, str(tmp_path / "t"), rows.schema).collect()] == [1]
