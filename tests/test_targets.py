"""Deleting, replacing, truncating and creating targets; flows over them."""

import os

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyferry import session
from tallyferry.functions.predicates import date_window
from tallyferry.operators import maintain as M
from tallyferry.operators import reconcile as R
from tallyferry.operators.sizing import analyzed_bytes, chunk_rows_for, stored_mb
from tallyferry.plans import backfill as B
from tallyferry.plans.audit import reconcile_tables, schema_specs
from tallyferry.plans.export import export_table, export_tables
from tallyferry.plans.imports import housekeep, import_table, import_tables
from tallyferry.session import materialise, release_scratch, scratch_root
from tallyferry.session import estimated_bytes, partitions_for
from tallyferry.sources.delimited import line_counts
from tallyferry.specs import (
    MissingInput, ModeConflict, Settings, TableSpec, TooManyBadRows, Window,
)

EVENTS = TableSpec("mart.events", "event_id", "ts", ("event_id",), target_name="copy.events")


def test_delete_keeps_rows_the_condition_does_not_decide(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 50)], "id int, x int")
    assert values(M.delete_rows(df, F.col("x") > 10)) == [(1, None), (2, 5)]


def test_replace_rows_twice_is_once(table):
    orders = table("orders")
    condition = F.col("o_orderkey") < 100
    fresh = orders.where(condition).withColumn("o_totalprice", F.lit(0.0))
    once = M.replace_rows(orders, condition, fresh)
    assert values(M.replace_rows(once, condition, fresh)) == values(once)


@pytest.mark.parametrize(
    "start, end",
    [("2024-01-05 00:00:00", "2024-01-08 00:00:00"), ("2024-01-05 07:30:00", "2024-01-08 16:00:00"),
     ("2024-01-05 07:30:00", "2024-01-05 09:00:00"), (None, "2024-01-03 12:00:00"), ("2024-01-28 00:00:00", None)],
)
def test_replace_window_equals_delete_and_insert(spark, table, tmp_path, start, end):
    events, path, window = table("events"), str(tmp_path / "t"), Window(start, end)
    old = events.withColumn("value", F.lit(-1.0)).withColumn(
        "ts", F.when(F.col("event_id") % 50 != 0, F.col("ts"))
    )
    M.write_days(old, path, "ts")
    fresh = events.where(F.col("event_id") % 3 == 0)
    expected = M.replace_rows(old, date_window(old, "ts", window), fresh.where(date_window(fresh, "ts", window)))
    for _ in range(2):
        M.replace_window(spark, path, fresh, "ts", window)
        assert values(M.read_target(spark, path, events.schema)) == values(expected)


def test_unpadded_windows_spare_the_days_after(spark, table, tmp_path):
    events, path = table("events"), str(tmp_path / "t")
    M.write_days(events, path, "ts")
    M.replace_window(spark, path, events, "ts", Window("2024-1-5 00:00:00", "2024-1-20 0:00:00"))
    assert values(M.read_target(spark, path, events.schema)) == values(events)
    with pytest.raises(ValueError, match="empty"):
        Window("2024-01-05 00:00:00", "2024-1-5 00:00:00")


def test_appending_to_a_target_by_days(spark, table, tmp_path):
    events, path = table("events"), str(tmp_path / "t")
    early = events.where("event_id < 300")
    M.write_days(early, path, "ts")
    with pytest.raises(ValueError, match="by day"):
        M.append_path(events.where("event_id >= 300"), path, events.schema)
    M.append_path(events.where("event_id >= 300"), path, events.schema, "ts")
    assert values(M.read_target(spark, path, events.schema)) == values(events)


def test_sizes_come_from_the_tables_that_are_read(spark, table):
    memory = spark.createDataFrame([(1, 2.0)], "k long, x double")
    assert estimated_bytes(memory) is None or estimated_bytes(memory) < 10_000
    assert estimated_bytes(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "k long")) is None
    assert stored_mb(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "k long")) < 0.01
    parts = [table(n) for n in ("orders", "customer", "lineitem")]
    joined = parts[0].crossJoin(parts[1]).crossJoin(parts[2])
    assert estimated_bytes(joined) <= sum(estimated_bytes(p) for p in parts)
    assert partitions_for(joined) is None


def test_replacing_with_nothing_empties_the_window(spark, table, tmp_path):
    events, path = table("events"), str(tmp_path / "t")
    M.write_days(events, path, "ts")
    M.replace_window(spark, path, events.limit(0), "ts", Window("2024-01-01 00:00:00", "2024-01-10 00:00:00"))
    left = M.read_target(spark, path, events.schema)
    assert values(left) == values(events.where("ts >= timestamp_ntz'2024-01-10'"))
    assert not any(n < "day_part=2024-01-10" for n in os.listdir(path) if n.startswith("day_part"))


def test_window_needs_a_target_by_days(spark, table, tmp_path):
    events, path = table("events"), str(tmp_path / "t")
    M.append_path(events, path, events.schema)
    with pytest.raises(ValueError, match="not partitioned by day"):
        M.replace_window(spark, path, events, "ts", Window(end="2024-01-02 00:00:00"))


def test_truncate_keeps_the_schema(spark, table, tmp_path):
    orders, path = table("orders"), str(tmp_path / "t")
    M.append_path(orders, path, orders.schema)
    M.truncate_path(spark, path, orders.schema)
    assert spark.read.parquet(path).schema == orders.schema
    assert M.read_target(spark, path, orders.schema).count() == 0


def test_catalog_tables(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("UUID", T.StringType())])
    M.create_if_absent(spark, "copied", schema)
    M.create_if_absent(spark, "copied", schema)
    rows = spark.createDataFrame([("u1", 1), ("u2", 2)], "UUID string, id long")
    M.append_target(spark, "copied", rows)
    M.append_target(spark, "copied", rows)
    assert values(spark.table("copied")) == [(1, "u1"), (1, "u1"), (2, "u2"), (2, "u2")]
    assert analyzed_bytes(spark, "copied") is None
    spark.sql("ANALYZE TABLE copied COMPUTE STATISTICS")
    assert analyzed_bytes(spark, "copied") > 0
    M.truncate_tables(spark, ["copied"])
    assert spark.table("copied").count() == 0
    M.drop_if_present(spark, ["copied", "never_there"])
    assert not spark.catalog.tableExists("copied")


def test_report_over_a_catalog_schema(spark, table):
    spark.sql("CREATE DATABASE IF NOT EXISTS mart")
    for name in ("region", "nation"):
        table(name).write.mode("overwrite").saveAsTable(f"mart.{name}")
    specs = schema_specs(spark, "mart")
    assert [s.name for s in specs] == ["mart.nation", "mart.region"]
    read = lambda spec: spark.table(spec.name)
    report = reconcile_tables(read, lambda spec: read(spec).limit(3), specs)
    assert {(r["table_name"], r["status"]) for r in report.where("checksum_class = 'fingerprint'").collect()} == {
        ("mart.nation", R.FAILURE), ("mart.region", R.FAILURE)}
    M.drop_if_present(spark, [s.name for s in specs])


def test_export_modes_and_layout(spark, table, tmp_path):
    events, out = table("events"), str(tmp_path / "out")
    with pytest.raises(ModeConflict):
        export_table(events, EVENTS, out, sample_size=5, window=Window(end="2024-01-02 00:00:00"))
    whole = export_table(events, EVENTS, out)
    assert whole.chunks == 1 and sorted(os.listdir(out)) == ["mart.events"]
    settings = Settings(chunking=True, whole_table_mb=0, chunk_mb=0.02)
    cut = export_table(table("lineitem"), TableSpec("mart.lineitem", "l_orderkey"), out, settings=settings)
    folders = [n for n in os.listdir(f"{out}/mart.lineitem") if n.startswith("chunk_id=")]
    assert len(folders) == cut.chunks > 1


def test_export_without_partition_column_moves_everything(spark, table, tmp_path):
    region = table("region")
    spec = TableSpec("region")
    for kwargs in ({"sample_size": 2}, {"window": Window(end="2024-01-02 00:00:00")}, {}):
        export_table(region, spec, str(tmp_path / "out"), **kwargs)
        target = str(tmp_path / f"t{len(os.listdir(tmp_path))}")
        back = import_table(spark, spec, region.schema, str(tmp_path / "out"), target)
        assert values(back) == values(region)


def test_hot_key_moves_whole_through_chunks(spark, tmp_path):
    """Half of the rows share one key, some have none: files stay small, nothing is lost."""
    hot = F.when(F.col("id") % 2 == 0, 7000).when(F.col("id") % 97 != 0, F.col("id"))
    df = spark.range(0, 40_000, 1, 16).select("id", hot.alias("k"), F.repeat(F.lit("x"), 40).alias("pad"))
    df = materialise(df, "hot")
    spec = TableSpec("hot", "k")
    settings = Settings(chunking=True, whole_table_mb=0, chunk_mb=0.05)
    done = export_table(df, spec, str(tmp_path / "out"), settings=settings)
    chunk_rows = chunk_rows_for(round(stored_mb(df), 1), 40_000, settings.chunk_mb)
    keyed = df.where("k is not null").count()
    assert 1 < done.chunks == keyed // chunk_rows
    longest = line_counts(spark, done.path).agg(F.max("lines")).first()[0]
    assert longest - 1 <= chunk_rows < 20_000
    back = import_table(spark, spec, df.schema, str(tmp_path / "out"), str(tmp_path / "t"), settings=settings)
    assert {r["status"] for r in R.reconcile(df, back, "hot").collect()} == {R.SUCCESS}


def test_sample_export_is_in_descending_order(spark, table, tmp_path):
    orders = table("orders")
    spec = TableSpec("orders", "o_orderkey", "o_orderdate")
    done = export_table(orders, spec, str(tmp_path), sample_size=200, settings=Settings(compression=None))
    folder = f"{done.path}/chunk_id=0"
    keys = []
    for name in sorted(n for n in os.listdir(folder) if n.endswith(".csv")):
        with open(f"{folder}/{name}") as f:
            keys += [int(line.split("\t")[0]) for line in f.read().splitlines()[1:]]
    top = orders.agg(F.max("o_orderkey")).first()[0]
    assert len(keys) == 200 and keys == sorted(keys, reverse=True) and top not in keys


def test_whole_job_reports_success_then_failure(spark, table, tmp_path):
    specs = [EVENTS, TableSpec("mart.region")]
    read = lambda spec: table(spec.name.split(".")[1])
    out, targets = str(tmp_path / "out"), str(tmp_path / "targets")
    window = Window("2024-01-10 00:00:00", "2024-01-20 00:00:00")
    with pytest.raises(MissingInput, match="mart.region"):
        import_tables(spark, read, specs, out, targets)
    done = export_tables(spark, read, specs, out, window=window)
    conditions = {d.spec.name: d.condition for d in done}
    for round_ in range(3):
        # Emptied in full, except once: there the window of events is replaced.
        housekeep(spark, read, specs if round_ != 1 else specs[1:], targets)
        report = import_tables(spark, read, specs, out, targets, window, conditions=conditions)
        assert {r["status"] for r in report.collect()} == {R.SUCCESS}
    spoiled = lambda spec: M.read_target(spark, f"{targets}/{spec.target}", read(spec).schema).limit(4)
    report = reconcile_tables(read, spoiled, specs, conditions)
    assert {r["status"] for r in report.where("checksum_class = 'fingerprint'").collect()} == {R.FAILURE}


def test_bad_row_budget_protects_the_target(spark, tmp_path):
    os.makedirs(tmp_path / "in" / "t")
    with open(tmp_path / "in" / "t" / "0.csv", "w") as f:
        f.write("id\tx\n" + "".join(f"{i}\t{'bad' if i < 4 else i}\n" for i in range(50)))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.LongType())])
    target = str(tmp_path / "t")
    with pytest.raises(TooManyBadRows, match="4 bad rows, 3 allowed"):
        import_table(spark, TableSpec("t"), schema, str(tmp_path / "in"), target, settings=Settings(max_bad_rows=3))
    assert not os.path.exists(target)
    refused = str(tmp_path / "refused")
    loaded = import_table(
        spark, TableSpec("t"), schema, str(tmp_path / "in"), target,
        settings=Settings(max_bad_rows=4), quarantine=refused,
    )
    assert loaded.count() == 46
    bad = spark.read.parquet(refused)
    assert values(bad.select("bad_reason", "bad_line"))[0] == ("not of its type: x", "0\tbad")
    assert sorted(r["bad_line_number"] for r in bad.collect()) == [2, 3, 4, 5]


def test_backfill_is_idempotent_over_any_sub_range(spark, table, tmp_path):
    events, target = table("events"), str(tmp_path / "t")
    for start, end in (("2024-01-01", "2024-01-15"), ("2024-01-10", "2024-02-05"), ("2024-01-03", "2024-01-04")):
        report = B.backfill(spark, events, EVENTS, target, start, end)
        assert {r["status"] for r in report.collect()} == {R.SUCCESS}
    assert values(M.read_target(spark, target, events.schema)) == values(events)


def test_day_windows_are_empty_for_an_empty_range(spark):
    assert B.day_windows(spark, "2024-01-05", "2024-01-05").count() == 0
    assert [str(r[0]) for r in B.day_windows(spark, "2024-02-28", "2024-03-02").collect()] == [
        "2024-02-28", "2024-02-29", "2024-03-01"]


def test_bookmarks_keep_the_last_mark(spark, table, tmp_path):
    orders, path = table("orders"), str(tmp_path / "marks")
    part = orders.where("o_orderkey < 500")
    B.save_bookmarks(B.bookmark(part, "orders", "o_orderkey"), path, "2024-01-01 00:00:00")
    B.save_bookmarks(B.bookmark(orders, "orders", "o_orderkey"), path, "2024-01-02 00:00:00")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    assert values(B.latest_bookmarks(spark.read.parquet(path))) == [("orders", str(top))]


def test_a_table_may_fix_its_sample_window(spark, table, tmp_path):
    events, window = table("events"), Window("2024-01-03 00:00:00", "2024-01-04 00:00:00")
    spec = TableSpec("events", "event_id", "ts", sample_window=window)
    done = export_table(events, spec, str(tmp_path / "out"), sample_size=5)
    back = import_table(spark, spec, events.schema, str(tmp_path / "out"), str(tmp_path / "t"))
    assert values(back) == values(events.where(date_window(events, "ts", window)))
    assert values(back) == values(events.where(done.condition))


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(session, "_CHECKPOINT_CONF", "spark.no.such.setting")
    assert os.path.isdir(scratch_root(spark).split("/tallyferry/")[0])

    class Elsewhere:
        conf = spark.conf

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="every executor"):
        scratch_root(Elsewhere)


def test_scratch_is_shared_and_released(spark):
    df = materialise(spark.range(5), "probe")
    assert df.count() == 5
    assert scratch_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    release_scratch(spark)
    assert not os.path.exists(scratch_root(spark))
