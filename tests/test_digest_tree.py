"""The digest tree against the join of everything."""

import pytest
from conftest import values
from pyspark.sql import functions as F

from tallyferry.operators import diffs as D
from tallyferry.operators import digest_tree as G

KINDS = {"bigint": "id", "string": "concat('k', lpad(cast(id as string), 6, '0'))", "date": "date_add(date '2000-01-01', cast(id as int))"}


@pytest.mark.parametrize("leaves", [1, 8, 300])
@pytest.mark.parametrize("dtype", sorted(KINDS))
def test_same_lines_as_the_whole_join(spark, dtype, leaves):
    source = spark.range(0, 3000, 1, 6).select(F.expr(KINDS[dtype]).alias("k"), (F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    changed = source.withColumn("a", F.when(F.col("b").between(700, 720), 99).when(F.col("b") == 1500, None).otherwise(F.col("a")))
    target = changed.where("b not between 2000 and 2003").unionByName(
        source.limit(2).select(F.when(F.col("b") >= 0, None).cast(dtype).alias("k"), "a", "b").limit(1)
    )
    found = G.tree_diff(source, target, ["k"], leaves=leaves)
    assert values(found.lines) == values(D.field_diff(source, target, ["k"]))
    if leaves == 300:
        assert 25 <= found.source_rows < 150 and found.ranges < 8


def test_equal_copies_read_nothing(spark, table):
    orders = table("orders")
    found = G.tree_diff(orders, orders.repartition(9), ["o_orderkey"])
    assert (found.source_rows, found.target_rows, found.ranges) == (0, 0, 0) and found.lines.isEmpty()
    none = orders.limit(0)
    assert G.tree_diff(none, none, ["o_orderkey"]).lines.isEmpty()
    assert G.tree_diff(none, orders, ["o_orderkey"]).lines.where("kind = 'target_only'").count() == orders.count()


def test_few_ranges_are_a_pushed_filter(table):
    orders = table("orders")
    low = orders.agg(F.min("o_orderkey")).first()[0]
    copy = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") == low, -1).otherwise(F.col("o_custkey")))
    found = G.tree_diff(orders, copy, ["o_orderkey"], leaves=50)
    assert found.source_rows < orders.count() / 20
    plan = found.lines._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderkey" in plan


def test_levels_add_up(table):
    orders = table("orders")
    cuts = [r[0] for r in orders.select("o_orderkey").distinct().orderBy("o_orderkey").collect()][5::9]
    tree = G.digest_tree(orders, "o_orderkey", cuts, orders.columns)
    sums = {r["level"]: (r["n"], r["s"]) for r in tree.groupBy("level").agg(F.sum("n_rows").alias("n"), F.sum("total").alias("s")).collect()}
    assert len(sums) == 1 + G.depth_of(len(cuts) + 2) and len(set(sums.values())) == 1
    assert tree.where("level = 0").count() == 1
