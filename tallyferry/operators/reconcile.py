"""Source against target: one SUCCESS / FAILURE / WARNING line per check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.functions.text import quoted
from tallyferry.operators.checksum import checksums
from tallyferry.operators.columns import UNCHECKED

SUCCESS, FAILURE, WARNING = "SUCCESS", "FAILURE", "WARNING"

# Doubles are summed in varying order; beyond this relative gap sums differ for real.
FLOAT_TOLERANCE = 1e-9


def reconcile(
    source: DataFrame,
    target: DataFrame,
    table_name: str,
    where: Column | None = None,
    by: Sequence[str] = (),
    fingerprint: str | None = "xxhash64",
) -> DataFrame:
    """Checksums of both sides, compared.

    ``where`` is applied to both sides, so that only the moved slice counts;
    ``by`` compares group by group, a group missing on one side has 0 rows there.
    """
    left = checksums(source, table_name, where, by, fingerprint)
    right = checksums(target, table_name, where, by, fingerprint)
    return compare_checksums(left, right, by)


def compare_checksums(source: DataFrame, target: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Match two checksum tables on (table, group, class) and judge each pair."""
    keys = ["table_name", *by, "checksum_class"]
    # Each side has one line per key, so the maximum of a side is its value. Grouping
    # matches NULL groups, which a join would not, and takes one small shuffle.
    both = source.withColumn("side", F.lit("source")).unionByName(
        target.withColumn("side", F.lit("target"))
    )
    picked = [
        F.max(F.when(F.col("side") == side, F.col(column))).alias(f"{side}_{name}")
        for side in ("source", "target")
        for column, name in (
            ("row_count", "rows"), ("value", "num"), ("raw_value", "raw"), ("digest", "digest")
        )
    ]
    paired = both.groupBy(*keys).agg(F.max("column_count").alias("column_count"), *picked)
    judged = paired.fillna(0, ["source_rows", "target_rows"]).selectExpr(
        *[quoted(k) for k in keys],
        f"{_STATUS} as status",
        f"{_shown('source')} as source_value",
        f"{_shown('target')} as target_value",
        "source_rows",
        "target_rows",
        "column_count",
    )
    return judged.selectExpr(
        *[quoted(k) for k in keys],
        "status", "source_value", "target_value", "source_rows", "target_rows",
        f"{_MESSAGE} as message",
    )


_ROWS_AGREE = "source_rows = target_rows"
# Equal (NaN and infinities too) or nearly so.
_FLOATS_AGREE = (
    "(source_raw <=> target_raw or coalesce(abs(source_raw - target_raw)"
    f" <= greatest(abs(source_raw), abs(target_raw)) * {FLOAT_TOLERANCE}D, false))"
)
# A target slice without rows has no average: only the row counts can be compared.
_STATUS = f"""case
    when checksum_class = '{UNCHECKED}' then '{WARNING}'
    when column_count = 0 then '{SUCCESS}'
    when not ({_ROWS_AGREE}) then '{FAILURE}'
    when checksum_class = 'fingerprint'
        then if(source_digest <=> target_digest, '{SUCCESS}', '{FAILURE}')
    when target_num is null then '{SUCCESS}'
    when checksum_class = 'float' then if({_FLOATS_AGREE}, '{SUCCESS}', '{FAILURE}')
    else if(source_num <=> target_num, '{SUCCESS}', '{FAILURE}') end"""
_MESSAGE = f"""concat_ws(' ', status, concat(table_name, ':'), case
    when checksum_class = '{UNCHECKED}' then concat(column_count, ' columns not covered by a checksum')
    when column_count = 0 then concat('no ', checksum_class, ' columns')
    else concat(
        if(target_value is null, '',
           concat(coalesce(source_value, '0'), ' vs ', target_value, ' and ')),
        'ROWS: ', source_rows, ' vs ', target_rows) end)"""


def _shown(side: str) -> str:
    return f"""case
        when checksum_class = 'fingerprint' then cast({side}_digest as string)
        when {side}_num is null then cast(null as string)
        when checksum_class = 'temporal' then format_string('%.0f', {side}_num)
        else format_string('%.2f', {side}_num) end"""


def stamp_report(report: DataFrame, run_ts: str) -> DataFrame:
    """Mark report lines with the run they belong to."""
    return report.withColumn("run_ts", F.lit(run_ts).cast("timestamp_ntz"))


def save_report(report: DataFrame, path: str, run_ts: str) -> None:
    """Append the lines of one run to a report table."""
    stamp_report(report, run_ts).write.mode("append").parquet(path)


def failure_scan(reports: DataFrame, expected: DataFrame, run: str) -> DataFrame:
    """FAILURE lines, and a line for each expected run without any report.

    ``run`` is the column (a day, say) that both tables share.
    """
    failed = reports.where(F.col("status") == FAILURE).select(
        run, "table_name", "checksum_class", F.lit("failed check").alias("problem")
    )
    nothing = F.lit(None).cast("string")
    missing = expected.select(run).distinct().join(reports.select(run).distinct(), run, "left_anti")
    return failed.unionByName(
        missing.select(
            run, nothing.alias("table_name"), nothing.alias("checksum_class"),
            F.lit("no report").alias("problem"),
        )
    )
