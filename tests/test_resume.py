"""Batched imports and backfills that break and go on; samples with a date floor."""

import os

import pytest
from conftest import values
from pyspark.sql import functions as F

from tallyferry.operators import maintain as M
from tallyferry.operators import select as X
from tallyferry.plans import backfill as B
from tallyferry.plans.export import export_table
from tallyferry.plans.imports import import_table
from tallyferry.specs import Settings, TableSpec, Window
from tallyferry.streaming import file_batches as S

EVENTS = TableSpec("events", "event_id", "ts", ("event_id",))
WINDOW = Window("2024-01-08 00:00:00", "2024-01-22 00:00:00")


@pytest.fixture()
def exported(table, tmp_path):
    settings = Settings(files_per_batch=3)
    events = table("events")
    done = export_table(events.repartition(7), EVENTS, str(tmp_path / "out"), window=WINDOW, settings=settings)
    return events, events.where(done.condition), str(tmp_path / "out"), settings


def test_rerun_with_the_same_progress_adds_nothing(spark, exported, tmp_path):
    events, moved, out, settings = exported
    target, progress = str(tmp_path / "target"), str(tmp_path / "progress")
    for _ in range(2):
        loaded = import_table(spark, EVENTS, events.schema, out, target, settings=settings, progress=progress)
    assert M.is_by_day(spark, target) and len(os.listdir(f"{target}/_batches")) > 1
    assert values(loaded) == values(moved)


def test_a_batch_that_runs_twice_replaces_its_own_rows(spark, exported, tmp_path, monkeypatch):
    events, moved, out, settings = exported
    target, progress = str(tmp_path / "target"), str(tmp_path / "progress")
    real, met = M.publish_files, []

    def breaking(spark, staged, target, name):
        real(spark, staged, target, name)
        met.append(name)
        if len(met) == 2:
            raise RuntimeError("killed after the files moved, before the stream knew")

    monkeypatch.setattr(S, "publish_files", breaking)
    with pytest.raises(Exception, match="killed"):
        import_table(spark, EVENTS, events.schema, out, target, settings=settings, progress=progress)
    loaded = import_table(spark, EVENTS, events.schema, out, target, settings=settings, progress=progress)
    assert met[1] == met[2]
    assert values(loaded) == values(moved)


def test_window_import_in_batches_is_idempotent(spark, exported, tmp_path):
    events, moved, out, settings = exported
    target = str(tmp_path / "target")
    for _ in range(2):
        loaded = import_table(spark, EVENTS, events.schema, out, target, WINDOW, settings)
    assert values(loaded) == values(moved)


def test_backfill_goes_on_where_it_stopped(spark, table, tmp_path, monkeypatch):
    events = table("events")
    target, state = str(tmp_path / "target"), str(tmp_path / "state")
    real, steps = B.replace_days, []

    def breaking(spark, path, fresh, date_col, days):
        steps.append(days)
        if len(steps) == 3:
            raise RuntimeError("killed")
        real(spark, path, fresh, date_col, days)

    monkeypatch.setattr(B, "replace_days", breaking)
    with pytest.raises(RuntimeError, match="killed"):
        B.backfill(spark, events, EVENTS, target, "2024-01-05", "2024-01-14", state, "2024-02-01 00:00:00", days_per_step=3)
    assert {r["status"] for r in B.day_states(spark, state).collect()} == {"checked"}
    report = B.backfill(spark, events, EVENTS, target, "2024-01-05", "2024-01-14", state, "2024-02-02 00:00:00", days_per_step=3)
    days = [f"2024-01-{d:02d}" for d in range(5, 14)]
    assert steps == [days[:3], days[3:6], days[6:], days[6:]]
    assert {str(r["run_day"]) for r in report.select("run_day").collect()} == set(days[6:])
    window = "ts >= timestamp_ntz'2024-01-05' and ts < timestamp_ntz'2024-01-14'"
    assert values(M.read_target(spark, target, events.schema)) == values(events.where(window))
    assert B.open_days(spark, state, "2024-01-05", "2024-01-14") == []
    with pytest.raises(ValueError, match="run_ts"):
        B.backfill(spark, events, EVENTS, target, "2024-01-05", "2024-01-06", state)


def test_days_that_fail_their_check_stay_open(spark, table, tmp_path, monkeypatch):
    events = table("events")
    target, state = str(tmp_path / "target"), str(tmp_path / "state")
    real = B.read_target
    monkeypatch.setattr(B, "read_target", lambda *a: real(*a).where("ts < timestamp_ntz'2024-01-06 12:00:00'"))
    B.backfill(spark, events, EVENTS, target, "2024-01-05", "2024-01-08", state, "2024-02-01 00:00:00")
    assert B.open_days(spark, state, "2024-01-05", "2024-01-08") == ["2024-01-06", "2024-01-07"]


def test_date_floor_is_the_oldest_of_the_newest_keys(spark):
    df = spark.range(100).select(
        F.col("id").alias("k"), F.expr("date_add(date '2024-01-01', cast(if(id % 10 = 0, 0, id) as int))").alias("d")
    )
    spec = TableSpec("t", "k", "d", sample_floor=True)
    floor = X.date_floor(df, "k", "d", 5)
    assert str(df.select(floor.alias("f")).first()["f"]) == "2024-01-01"
    low, high, condition = X.sample_slice(df, "k", 5, "d", floor)
    # Rows of the floor's own date (every tenth) have no rank.
    ranked = sorted((k for k in range(100) if k % 10), reverse=True)
    assert (low, high) == (str(ranked[5]), "99") and df.where(condition).count() == 99 - ranked[5]
    assert spec.sample_floor and X.date_floor(df.limit(0), "k", "d", 5) is None
