"""Reconciling many tables, and keeping the reports of past runs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession

from tallyferry.operators.reconcile import reconcile
from tallyferry.specs import TableSpec

Reader = Callable[[TableSpec], DataFrame]


def reconcile_tables(
    read_source: Reader,
    read_target: Reader,
    specs: Iterable[TableSpec],
    conditions: Mapping[str, Column] | None = None,
    fingerprint: str | None = "xxhash64",
) -> DataFrame:
    """One report over one table, a list, or all tables of a job.

    ``conditions`` names the slice per table; source and target may have other names.
    """
    reports = [
        reconcile(
            read_source(spec), read_target(spec), spec.name,
            (conditions or {}).get(spec.name), fingerprint=fingerprint,
        )
        for spec in specs
    ]
    return reduce(DataFrame.unionByName, reports)


def schema_specs(spark: SparkSession, schema: str) -> list[TableSpec]:
    """Specs of all tables of a catalog schema, for a report over the whole schema."""
    names = spark.sql(f"SHOW TABLES IN {schema}").where("NOT isTemporary").select("tableName")
    return [TableSpec(f"{schema}.{r[0]}") for r in names.collect()]
