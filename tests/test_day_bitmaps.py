"""Distinct days by bitmaps against the values themselves."""

import pytest
from conftest import values
from pyspark.sql import functions as F

from tallyferry.operators import checksum as K


@pytest.fixture()
def dated(spark):
    """Days from 1820 to 2300, some missing, and times of them."""
    day = F.expr("date_add(date '1970-01-01', cast(id * 7919 % 176000 - 55000 as int))")
    return spark.range(0, 5000, 1, 8).select(
        (F.col("id") % 4).alias("g"), F.when(F.col("id") % 11 != 0, day).alias("d"),
        F.when(F.col("id") % 3 == 0, F.expr("date '1970-01-01'")).otherwise(F.expr("date '1969-12-31'")).alias("e"),
        (day.cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") % 2)).alias("t"),
    )


def shown(df, by=()):
    lines = K.checksums(df, "x", by=list(by), classes=["temporal"])
    return values(lines.select(*by, "column_count", "value", "row_count"))


@pytest.mark.parametrize("columns", [["d"], ["d", "e"], ["d", "e", "t"], ["t"], ["t", "e"]])
@pytest.mark.parametrize("by", [(), ("g",)])
def test_equal_to_distinct_values(dated, columns, by):
    df = dated.select(*by, *columns)
    # The same as times, which are counted by their values.
    same = df.select(*by, *[F.col(c).cast("timestamp_ntz").alias(c) for c in columns])
    want = values(
        df.groupBy(*by).agg(
            F.lit(len(columns)).cast("bigint").alias("column_count"),
            sum((F.countDistinct(c) for c in columns[1:]), F.countDistinct(columns[0])).cast("double").alias("value"),
            F.count(F.lit(1)).alias("row_count"),
        )
    )
    assert shown(df, by) == shown(same, by) == want


def test_empty_and_null_dates(spark, dated):
    assert shown(dated.limit(0).select("d", "t")) == [(2, 0.0, 0)]
    nothing = dated.select(F.lit(None).cast("date").alias("d"))
    assert shown(nothing) == [(1, 0.0, 5000)]


def test_days_are_not_shuffled_one_by_one(dated):
    days = K._day_bitmaps(dated, ["d", "e"], [], True)
    # Six spans of 90 years and NULL for one column, two for the other.
    assert days.count() <= 10
