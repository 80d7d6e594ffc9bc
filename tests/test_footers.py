"""Footers against scans, with NULLs, nested columns and many files."""

import pytest
from conftest import SMALL, values
from pyspark.sql import functions as F

from tallyferry.functions.scalars import ordinal
from tallyferry.operators.checksum import table_counts
from tallyferry.operators.columns import list_columns, schema_diff
from tallyferry.sources import footers as N


@pytest.mark.parametrize("name", ["lineitem", "orders", "events", "embeddings", "documents"])
def test_columns_as_scanned(spark, table, name):
    assert values(N.list_columns_by_footers(spark, f"{SMALL}/{name}.parquet")) == values(list_columns(table(name)))


def test_many_files_with_nulls_and_nested_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 3000, 1, 70).select(
        F.when(F.col("id") % 7 != 0, F.col("id") - 500).alias("k"), F.lit(None).cast("long").alias("never"),
        F.when(F.col("id") < 100, F.col("id").cast("int")).alias("few"), F.struct(F.col("id").alias("k")).alias("s"),
        F.when(F.col("id") % 3 == 0, F.array("id")).alias("a"), F.expr("date_add(date '1960-01-01', cast(id as int))").alias("d"),
        F.expr("timestamp_ntz'1969-12-31 23:00:00' + make_dt_interval(0, 0, 0, id)").alias("t"), F.expr("cast(id as string)").alias("x"),
    )
    df.write.parquet(path)
    assert values(N.list_columns_by_footers(spark, path)) == values(list_columns(df))
    facts = {r["column_name"]: r for r in N.footer_facts(spark, path).collect()}
    for name in ("k", "few", "d", "t"):
        low, high = df.agg(F.min(ordinal(df, name)), F.max(ordinal(df, name))).first()
        assert (facts[name]["low"], facts[name]["high"]) == (low, high)
    assert facts["never"]["non_null_rows"] == 0 and facts["never"]["high"] is None
    assert facts["s"]["non_null_rows"] is None and facts["x"]["high"] is None
    for name in ("k", "few", "never", "x"):
        assert values(N.max_key_by_footers(spark, path, name)) == values(df.agg(F.max(name).alias("max_key")))


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "empty")
    spark.createDataFrame([], "k long, x string").write.parquet(path)
    assert values(N.list_columns_by_footers(spark, path)) == values(list_columns(spark.read.parquet(path)))
    assert values(N.max_key_by_footers(spark, path, "k")) == [(None,)]


def test_counts_and_schemas_as_scanned(spark, table, tmp_path):
    path = str(tmp_path / "copy")
    copy = table("orders").select(F.col("o_orderkey").cast("int"), "o_orderstatus", F.array("o_custkey").alias("O_COMMENT"))
    copy.repartition(3).write.parquet(path)
    assert values(N.table_counts_by_footers(spark, path, "t")) == values(table_counts(copy, "t"))
    assert values(N.schema_diff_by_footers(spark, f"{SMALL}/orders.parquet", path)) == values(schema_diff(table("orders"), copy))


def test_columns_that_some_files_lack(spark, tmp_path):
    path = str(tmp_path / "grown")
    spark.range(0, 50, 1, 2).write.parquet(path)
    spark.range(50, 80, 1, 1).selectExpr("id", "id * 2 as more").write.mode("append").parquet(path)
    facts = {r["column_name"]: (r["row_count"], r["non_null_rows"], r["low"], r["high"]) for r in N.footer_facts(spark, path).collect()}
    assert facts == {"id": (80, 80, 0, 79), "more": (80, 30, 100, 158)}
    assert values(N.table_counts_by_footers(spark, path, "t")) == [("t", 80)]


def test_a_store_that_only_spark_opens(spark, table, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.store.link./t", f"file://{tmp_path}")
    df = spark.range(0, 900, 1, 5).select(
        F.when(F.col("id") % 7 != 0, F.col("id") - 500).alias("k"), F.lit(None).cast("long").alias("never"), F.array("id").alias("a"),
        F.expr("date_add(date '1960-01-01', cast(id as int))").alias("d"), F.expr("cast(id as string)").alias("x"),
        F.expr("timestamp_seconds(id)").alias("t"), F.when(F.col("id") < 100, F.col("id")).alias("few"),
    )
    df.write.parquet("viewfs://store/t/one")
    path = "viewfs://store/t/one"
    assert values(N.list_columns_by_footers(spark, path)) == values(list_columns(df))
    assert values(N.table_counts_by_footers(spark, path, "t")) == [("t", 900)]
    facts = {r["column_name"]: r for r in N.footer_facts(spark, path).collect()}
    for name in ("k", "never", "d"):
        assert (facts[name]["low"], facts[name]["high"]) == df.agg(F.min(ordinal(df, name)), F.max(ordinal(df, name))).first()
    assert facts["a"]["non_null_rows"] is None and facts["t"]["high"] is None
    for name in ("k", "never", "few", "x"):
        assert values(N.max_key_by_footers(spark, path, name)) == values(df.agg(F.max(name).alias("max_key")))
    df.write.option("parquet.column.statistics.enabled", "false").parquet("viewfs://store/t/bare")
    assert values(N.list_columns_by_footers(spark, "viewfs://store/t/bare")) == values(list_columns(df))
