"""Positions found without sorting: brute force over small brackets, hot keys and all types."""

from bisect import bisect_right
from decimal import Decimal

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from test_chunking import KEYS
from test_ordering import skewed

from tallyferry.functions.scalars import ordinal_literal
from tallyferry.operators import chunking as C
from tallyferry.operators import intervals as I
from tallyferry.operators import ordering as O
from tallyferry.operators import ranks as K


@pytest.mark.parametrize("dtype", sorted(KEYS))
def test_key_at_any_type(spark, monkeypatch, dtype):
    monkeypatch.setattr(K, "BRACKET_ROWS", 40)
    df = skewed(spark, 1500).select("id", F.expr(KEYS[dtype]).cast(dtype).alias("key"))
    keys = sorted(r["key"] for r in df.collect() if r["key"] is not None)
    for position in (1, 700, len(keys)):
        found = K.key_at(df, "key", position)
        shown = df.sparkSession.range(1).select(ordinal_literal(df, "key", found.ordinal).alias("k")).first()["k"]
        assert shown == keys[position - 1]
        assert (found.first, found.last) == (keys.index(shown) + 1, len(keys) - keys[::-1].index(shown))
    assert K.key_at(df, "key", len(keys) + 1) is None and K.key_at(df, "key", 0) is None


@pytest.mark.parametrize("bracket", [10, 300, 1_000_000])
@pytest.mark.parametrize("step", [1, 7, 130, 4000, 10_000])
def test_keys_at_multiples(spark, monkeypatch, bracket, step):
    monkeypatch.setattr(K, "BRACKET_ROWS", bracket)
    df = skewed(spark)
    keys = sorted(r["k"] for r in df.collect() if r["k"] is not None)
    found, total = K.keys_at_multiples(df, "k", step)
    assert total == len(keys)
    assert sorted(tuple(r) for r in found.collect()) == [(i, keys[i - 1]) for i in range(step, total + 1, step)]


def test_rows_outside_the_brackets_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(K, "BRACKET_ROWS", 100)
    df = spark.range(0, 200_000, 1, 8).selectExpr("id * 7919 % 200003 as k")
    met = []
    real = K._spans
    monkeypatch.setattr(K, "_spans", lambda counts, *a: met.append(counts.count()) or real(counts, *a))
    found, _ = K.keys_at_multiples(df, "k", 50_000)
    ordered = sorted(r[0] for r in df.collect())
    assert sorted(r["cut"] for r in found.collect()) == [ordered[i - 1] for i in range(50_000, 200_001, 50_000)]
    # Four positions among 64 intervals: about a sixteenth of the keys, not all.
    assert met[0] < 40_000


@pytest.mark.parametrize("bracket", [30, 1_000_000])
@pytest.mark.parametrize("limit", [0, 50_000])
def test_top_rows_with_ties_and_nulls(spark, monkeypatch, bracket, limit):
    monkeypatch.setattr(K, "BRACKET_ROWS", bracket)
    monkeypatch.setattr(O, "TOP_K_LIMIT", limit)
    df = skewed(spark, 900)
    keys = sorted((r["k"] for r in df.collect()), key=lambda k: (k is not None, k or 0), reverse=True)
    for rows in (0, 1, 250, 600, 895, 900, 2000):
        top = O.top_rows(df, "k", rows).collect()
        assert [r["k"] for r in top] == keys[:rows]
        assert len({r["id"] for r in top}) == len(top)


def test_thresholds_reach_the_scan(table):
    plan = O.top_rows(table("orders"), "o_orderkey", 50)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderkey" in plan and "Coalesce" not in plan


def test_repeated_hour_of_a_summer_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        # 02:30 happens twice on this day; the text of both is the same.
        df = spark.createDataFrame([(1729989000 + 3600 * i,) for i in range(4)], "s long").select(F.timestamp_seconds("s").alias("t"))
        for rows in (1, 2, 3):
            assert O.top_rows(df, "t", rows).count() == rows
            assert df.where(F.col("t") >= O.key_at_position(df, "t", rows).first()["key"]).count() >= 1
            found = K.key_at(df, "t", rows, descending=True)
            assert df.where(F.col("t") >= ordinal_literal(df, "t", found.ordinal)).count() == rows
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


MANY = {
    "bigint": [i * 3 - 400 for i in range(300)] + [2**62],
    "double": [float("-inf"), *(i / 7 for i in range(-200, 200)), float("inf")],
    "decimal(12,3)": [Decimal(i) / 8 for i in range(-150, 150)],
    "string": ["", "\x01", "a,b", "a|b", *(f"key-{i:03d}" for i in range(200)), "zé", "{c}", "\U0001f600"],
}


@pytest.mark.parametrize("dtype", sorted(MANY))
def test_many_cuts_are_searched_without_python_workers(spark, dtype):
    cuts = MANY[dtype][::2]
    df = spark.createDataFrame([(v,) for v in MANY[dtype]], f"v {dtype}")
    placed = df.withColumn("p", I.between_cuts(F.col("v"), cuts)).withColumn("c", I.is_cut(F.col("v"), cuts, F.col("p")))
    # Above 64 cuts each executor ran two Python workers a task before.
    assert "EvalPython" not in plan_of(placed)
    assert [tuple(r) for r in placed.collect()] == [(v, bisect_right(cuts, v), v in cuts) for v in MANY[dtype]]


def test_boundaries_and_chunks_start_no_python_workers(spark, monkeypatch):
    monkeypatch.setattr(K, "BRACKET_ROWS", 100)
    df = spark.range(0, 5000, 1, 4).selectExpr("id * 7919 % 5003 as k")
    assert "Python" not in plan_of(C.chunk_boundaries(df, "k", 40))
    plan = C.plan_chunks(df, "k", 40)
    assert plan.chunks > I.CASE_CUTS and "Python" not in plan_of(C.assign_chunks(df, plan))
