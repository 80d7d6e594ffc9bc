"""Reading tables: parquet folders, the catalog, or an external database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of a folder with one parquet file or directory per table."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_database_table(
    spark: SparkSession,
    table: str,
    options: Mapping[str, str],
    predicates: Sequence[str] | None = None,
    format_name: str = "jdbc",
) -> DataFrame:
    """A table of an external database.

    With ``predicates`` (see ``chunking.range_predicates``) each condition is
    one parallel read; they must not overlap and must cover every row.
    """
    if predicates is None:
        return spark.read.format(format_name).options(**options).option("dbtable", table).load()
    given = dict(options)
    url = given.pop("url")
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=given)
