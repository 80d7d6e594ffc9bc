"""Checksums, reports, fingerprints and differences."""

import decimal

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from tallyferry.functions.digests import row_digest
from tallyferry.functions.exact import exact_sum
from tallyferry.operators import checksum as K
from tallyferry.operators import columns as L
from tallyferry.operators import diffs as D
from tallyferry.operators import reconcile as R


def status(report):
    return {r["checksum_class"]: r["status"] for r in report.collect()}


def test_a_table_reconciles_with_itself(table):
    for name in ("orders", "lineitem", "events", "documents"):
        for algorithm in ("md5", "xxhash64"):
            report = R.reconcile(table(name), table(name).repartition(7), name, fingerprint=algorithm)
            assert set(status(report).values()) == {R.SUCCESS}


@pytest.mark.parametrize("column, value, failing", [
    ("o_totalprice", F.lit, {"float", "fingerprint"}),
    ("o_custkey", F.lit, {"number", "fingerprint"}),
])
def test_one_changed_cell_fails(table, column, value, failing):
    orders = table("orders")
    low = orders.agg(F.min("o_orderkey")).first()[0]
    changed = orders.withColumn(column, F.when(F.col("o_orderkey") == low, value(1_000_000)).otherwise(F.col(column)))
    found = status(R.reconcile(orders, changed, "orders"))
    assert {k for k, v in found.items() if v == R.FAILURE} == failing
    assert values(D.field_diff(orders, changed, ["o_orderkey"]))[0][1] == column


def test_swapped_cells_are_caught_by_the_fingerprint_only(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "id int, x int")
    b = spark.createDataFrame([(1, 20), (2, 10)], "id int, x int")
    assert status(R.reconcile(a, b, "t")) == {
        "string": R.SUCCESS, "number": R.SUCCESS, "float": R.SUCCESS, "temporal": R.SUCCESS, "fingerprint": R.FAILURE}


def test_empty_target_compares_rows_only(table):
    orders = table("orders")
    both_empty = R.reconcile(orders, orders, "orders", F.col("o_orderkey") < 0)
    assert set(status(both_empty).values()) == {R.SUCCESS}
    lost = R.reconcile(orders, orders.limit(0), "orders")
    assert set(status(lost).values()) == {R.FAILURE}
    message = lost.where("checksum_class = 'string'").first()["message"]
    assert message == f"FAILURE orders: ROWS: {orders.count()} vs 0"


def test_missing_class_is_a_success_and_unchecked_a_warning(table):
    report = R.reconcile(table("embeddings"), table("embeddings"), "embeddings", fingerprint=None)
    lines = {r["checksum_class"]: (r["status"], r["message"]) for r in report.collect()}
    assert lines["string"] == (R.SUCCESS, "SUCCESS embeddings: no string columns")
    assert lines["unchecked"] == (R.WARNING, "WARNING embeddings: 1 columns not covered by a checksum")


def test_float_sums_in_another_order_still_agree(spark):
    big = spark.range(0, 50000, 1, 9).select((F.rand(7) * 1e9).alias("x"), F.lit(0.1).alias("y"))
    kept = spark.createDataFrame(big.toPandas())
    assert status(R.reconcile(kept, kept.orderBy("x"), "t", fingerprint=None))["float"] == R.SUCCESS


def test_group_missing_on_one_side_fails(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "x int, g string")
    report = R.reconcile(a, a.where("g = 'a'"), "t", by=["g"], fingerprint=None)
    found = {(r["g"], r["checksum_class"]): r["status"] for r in report.collect()}
    assert found["a", "number"] == R.SUCCESS and found["b", "number"] == R.FAILURE


def test_null_groups_match(spark):
    a = spark.createDataFrame([(1, "a"), (2, None)], "x int, g string")
    report = R.reconcile(a, a, "t", by=["g"], fingerprint=None)
    assert {(r["g"], r["status"]) for r in report.collect()} == {("a", R.SUCCESS), (None, R.SUCCESS)}


def test_null_keys_match(spark):
    a = spark.createDataFrame([(1, None, "x"), (None, 2, "y")], "id int, part int, v string")
    b = spark.createDataFrame([(1, None, "x"), (None, 2, "z")], "id int, part int, v string")
    assert values(D.field_diff(a, b, ["id", "part"])) == [(None, 2, "v", "y", "z", "changed")]


def test_exact_sum_of_extreme_values(spark):
    rows = [2**63 - 1, -(2**63), 2**63 - 1, None, 5, -7, 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in rows], "x long")
    total = df.agg(exact_sum("x", df.schema["x"].dataType).alias("s")).first()["s"]
    assert total == decimal.Decimal(sum(v for v in rows if v is not None))
    for dtype in ("tinyint", "smallint", "int", "decimal(20,4)"):
        small = spark.createDataFrame([(-3,), (None,), (100,)], "x int").select(F.col("x").cast(dtype))
        assert small.agg(exact_sum("x", small.schema["x"].dataType)).first()[0] == 97
    assert df.limit(0).agg(exact_sum("x", df.schema["x"].dataType)).first()[0] == 0


@pytest.mark.parametrize("algorithm", ["md5", "xxhash64"])
def test_digests_tell_nulls_and_cell_borders_apart(spark, algorithm):
    rows = [("a|", "b"), ("a", "|b"), (None, "x"), ("x", None), ("", None), (None, ""), (None, None), ("-", "-")]
    df = spark.createDataFrame(rows, "a string, b string")
    digests = [r[0] for r in df.select(row_digest(df, algorithm)).collect()]
    assert len(set(digests)) == len(rows)
    assert all(0 <= d < 2**60 for d in digests)


def test_fingerprint_counts_copies(spark):
    one = spark.createDataFrame([(1,), (2,)], "x int")
    twice = one.unionByName(one.limit(1)).unionByName(one.limit(1))
    assert K.table_fingerprint(one, "t").first() != K.table_fingerprint(twice, "t").first()


def test_fingerprint_ignores_order(table):
    lines = table("lineitem")
    assert values(K.table_fingerprint(lines, "t")) == values(K.table_fingerprint(lines.orderBy("l_tax"), "t"))


def test_multiset_diff_counts_hot_copies(spark):
    a = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("x"), F.lit(None).cast("string").alias("y"))
    b = a.where("x <> 7").unionByName(spark.createDataFrame([(-1, None), (-1, None), (9, "new")], "x long, y string"))
    assert values(D.multiset_diff(a, b)) == [(-1, None, "target", 2), (7, None, "source", 1), (9, "new", "target", 1)]
    assert D.multiset_diff(a, a).isEmpty()


def test_field_diff_null_safe_and_missing_rows(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1.0), (3, None, None), (5, "s", 1.0)], "id int, a string, b double")
    b = spark.createDataFrame([(1, "x", None), (2, None, 2.0), (3, None, 0.0), (4, "n", None)], "id int, a string, b double")
    assert values(D.field_diff(a, b, ["id"])) == [
        (2, "a", "y", None, "changed"), (2, "b", "1.0", "2.0", "changed"), (3, "b", None, "0.0", "changed"),
        (4, None, None, None, "target_only"), (5, None, None, None, "source_only")]


def test_field_diff_refuses_repeated_keys(table):
    lines = table("lineitem")
    with pytest.raises(D.RepeatedKey, match="source"):
        D.field_diff(lines, lines, ["l_orderkey"])


def test_map_columns_compare_by_their_entries(spark):
    here = spark.sql("""select 1 as id, map('a', 1, 'b', 2) as m, map('q', map('z', 1)) as n
        union all select 2, null, null""")
    there = spark.sql("""select 1 as id, map('b', 2, 'a', 1) as m, map('q', map('z', 1)) as n
        union all select 2, map('a', 3), null""")
    status = {r["checksum_class"]: r["status"] for r in R.reconcile(here, here.where("id > 0"), "t").collect()}
    assert status["unchecked"] == "WARNING" and status["fingerprint"] == "SUCCESS"
    status = {r["checksum_class"]: r["status"] for r in R.reconcile(here, there, "t").collect()}
    assert status["fingerprint"] == "FAILURE"
    assert values(D.field_diff(here, there, ["id"]).select("id", "column_name", "kind")) == [(2, "m", "changed")]


@pytest.mark.parametrize("dtype, cells, mean", [
    ("decimal(38,0)", ["9" * 38, "9" * 38, "-1", None], 5e37),
    ("decimal(38,38)", ["0." + "9" * 38] * 3, 1.0),
    ("decimal(38,10)", ["-12345678901234567890123456.5", "2.25"], -6.172839450617284e24),
    ("decimal(30,2)", ["-0.75", "1.50"], 0.375),
])
def test_averages_of_wide_decimals(spark, dtype, cells, mean):
    df = spark.createDataFrame([(c,) for c in cells], "x string").selectExpr(f"cast(x as {dtype}) as x")
    assert K.checksums(df, "t", classes=("number",)).first()["raw_value"] == pytest.approx(mean, rel=1e-12)


def test_positional_diff_without_key(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "x int, y string")
    b = spark.createDataFrame([(2, "c"), (1, "a"), (1, "z")], "x int, y string")
    assert values(D.positional_diff(a, b)) == [(2, "y", "b", "z", "changed")]
    assert D.positional_diff(a, b, first_rows=1).isEmpty()
    assert values(D.positional_diff(a, b.limit(2))) == [(2, "x", "1", "2", "changed"), (2, "y", "b", "c", "changed"),
                                                       (3, None, None, None, "source_only")]


def test_schema_diff_counts_repeated_names(spark):
    a = spark.createDataFrame([(1, 2)], "x int, X int")
    b = spark.createDataFrame([(1, "q")], "x int, z string")
    found = values(L.schema_diff(a, b).select("column_name", "status"))
    assert found == [("x", "same"), ("x", "source_only"), ("z", "target_only")]


def test_classes_of_types(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    df = spark.sql("""select cast(1 as tinyint) a, cast(1 as decimal(5,2)) b, cast(1 as float) c, date '2024-01-01' d,
        timestamp '2024-01-01' e, timestamp_ntz '2024-01-01' f, time '12:00:00' g, true h, array(1) i, map(1, 2) j,
        named_struct('q', 1) k, 'x' l, interval 1 day m""")
    assert [r["checksum_class"] for r in L.list_columns(df).orderBy("position").collect()] == [
        "number", "number", "float", "temporal", "temporal", "temporal", "temporal",
        "unchecked", "unchecked", "unchecked", "unchecked", "string", "unchecked"]
    lines = {r["checksum_class"]: r for r in K.checksums(df.drop("j"), "t").collect()}
    assert lines["temporal"]["value"] == 4.0 and lines["number"]["value"] == 2.0


def test_reports_and_failure_scan(spark, tmp_path):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "x int, day string")
    path = str(tmp_path / "reports")
    R.save_report(R.reconcile(a, a, "t", by=["day"]), path, "2024-01-01 00:00:00")
    R.save_report(R.reconcile(a, a.where("x = 1"), "t", by=["day"]), path, "2024-01-02 00:00:00")
    reports = spark.read.parquet(path)
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "day string")
    found = values(R.failure_scan(reports.where("run_ts = timestamp_ntz'2024-01-01'"), expected, "day"))
    assert found == [("c", None, None, "no report")]
    found = values(R.failure_scan(reports, expected, "day"))
    assert ("b", "t", "number", "failed check") in found and not any(f[0] == "a" for f in found)


def test_average_checksums_shuffle_no_rows(table):
    plan = plan_of(K.checksums(table("lineitem"), "t", classes=["string", "number", "float"]))
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan
    assert "l_shipdate" not in plan.split("ReadSchema")[1]


def test_temporal_checksum_reads_only_temporal_columns(table):
    plan = plan_of(K.checksums(table("lineitem"), "t", classes=["temporal"]))
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in plan


def test_windowed_checksum_pushes_the_window(table):
    lines = table("lineitem")
    plan = plan_of(K.checksums(lines, "t", lines["l_shipdate"] >= F.lit("1996-01-01").cast("timestamp_ntz")))
    assert plan.count("GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)") == 2
