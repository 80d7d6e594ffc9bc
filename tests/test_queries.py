"""Every registered query against its oracle SQL."""

import pytest
from compare import connect, differences
from conftest import SMALL

import __spark_entry__ as entry_points
from tallyferry.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    function, sql = entry_points.queries()[name], entry_points.oracle_sql()[name]
    assert differences(spark, duck, SMALL, function, sql) is None


def test_entry_gives_rows(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["table_name", "checksum_class", "column_count", "value", "row_count"]
    assert df.count() == 4
