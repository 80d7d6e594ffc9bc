"""Positions and samples: brute force on small tables, with hot keys and ties."""

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from tallyferry.operators import ordering as O
from tallyferry.operators import select as X


def skewed(spark, rows=6000):
    """A third of the rows share key 500; some keys are NULL."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(500))
        .when(F.col("id") % 101 == 0, F.lit(None))
        .otherwise((F.col("id") * 7919) % 1000)
    )
    return spark.range(0, rows, 1, 12).select("id", key.cast("bigint").alias("k"))


def test_row_numbers_are_dense_and_ordered(spark):
    df = skewed(spark).where("k is not null")
    rows = O.number_rows(df, ["k"]).orderBy("row_num").collect()
    assert [r["row_num"] for r in rows] == list(range(1, len(rows) + 1))
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)
    assert {r["id"] for r in rows} == {r["id"] for r in df.collect()}


def test_hot_key_spreads_over_partitions(spark):
    df = spark.range(0, 4000, 1, 16).select(F.lit(1).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = O.number_rows(df, ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(numbered.inputFiles()) >= 4
    assert numbered.agg(F.countDistinct("row_num")).first()[0] == 4000


def test_empty_table_numbers_nothing(spark):
    assert O.number_rows(skewed(spark).where("k < 0"), ["k"]).count() == 0


def brute_ranks(keys):
    ordered = sorted((k for k in keys if k is not None), reverse=True)
    ranks = {}
    for position, key in enumerate(ordered, start=1):
        ranks.setdefault(key, position)
    return ordered, ranks


@pytest.mark.parametrize("limit", [O.TOP_K_LIMIT, 0])
@pytest.mark.parametrize("position", [1, 2, 57, 1500, 3000, 5990])
def test_key_at_position(spark, monkeypatch, limit, position):
    """Both ways, top-k and full order, agree with brute force."""
    monkeypatch.setattr(O, "TOP_K_LIMIT", limit)
    df = skewed(spark)
    ordered, ranks = brute_ranks([r["k"] for r in df.collect()])
    found = O.key_at_position(df, "k", position).first()
    if position > len(ordered):
        assert found["key"] is None and found["ranking"] is None
    else:
        assert found["key"] == ordered[position - 1]
        assert found["ranking"] == ranks[ordered[position - 1]]


def test_latest_sample_takes_ties_and_whole_small_tables(spark):
    df = skewed(spark)
    keys = [r["k"] for r in df.collect()]
    _, ranks = brute_ranks(keys)
    for n in (1, 10, 2600):
        expected = sum(1 for k in keys if k is not None and ranks[k] <= n)
        assert X.latest_sample(df, "k", n).count() == expected
    assert X.latest_sample(df, "k", 10_000).count() == len(keys)


def test_sample_slice_leaves_out_the_newest_key(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    low, high, condition = X.sample_slice(df, "k", 10)
    assert (low, high) == ("89", "99")
    assert values(df.where(condition)) == [(k,) for k in range(89, 99)]
    _, _, whole = X.sample_slice(df, "k", 10, include_max=True)
    assert df.where(whole).count() == 11


def test_sample_slice_falls_back_to_the_smallest_key(spark):
    df = spark.range(5).select(F.col("id").alias("k"))
    low, high, condition = X.sample_slice(df, "k", 100)
    assert (low, high) == ("0", "4")
    assert df.where(condition).count() == 4


def test_sample_of_timestamps_keeps_microseconds(spark):
    df = spark.range(50).select(
        (F.lit("2024-01-01 00:00:00.000001").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("k")
    )
    assert df.where(X.sample_slice(df, "k", 10)[2]).count() == 10


def test_top_k_plan_has_no_sort_of_the_table(table):
    plan = plan_of(O.newest(table("lineitem").select("l_orderkey"), "l_orderkey", 10))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_scan_prunes_columns_and_pushes_filters(table):
    df = X.scan_select(table("orders"), ["o_orderkey"], F.col("o_totalprice") > 5, "o_orderkey", 3)
    plan = plan_of(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "GreaterThan(o_totalprice,5.0)" in plan


def test_descending_sort_cuts_through_a_hot_key(spark):
    df = spark.range(0, 4000, 1, 16).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = X.sort_desc(df, "k").withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    keys = [r["k"] for r in rows]
    assert keys == sorted(keys, reverse=True)
    assert len({r["part"] for r in rows if r["k"] == 7}) > 1
