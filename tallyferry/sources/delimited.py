"""Delimited text with a header line: writing, reading, and telling bad rows apart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyferry.functions.text import escape_breaks, quoted, scrub_nul, unescape_breaks
from tallyferry.session import path_exists
from tallyferry.specs import MissingInput, Settings

RAW = "__raw_line"
CHUNK = "chunk_id"
REASON, LINE = "bad_reason", "bad_line"


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text that reads back to the same value.

    The writer's own timestamp format would cut microseconds.
    """
    return df.select([F.col(quoted(c)).cast("string").alias(c) for c in df.columns])


def _options(settings: Settings) -> dict[str, str]:
    return {
        "sep": settings.separator,
        "header": "true",
        "quote": '"',
        "escape": '"',
        "nullValue": settings.null_marker,
        "lineSep": "\n",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


def write_delimited(
    df: DataFrame, path: str, settings: Settings, chunked: bool = False, max_rows: int = 0
) -> None:
    """Replace ``path`` by delimited files of at most ``max_rows`` rows (0 = no limit);
    ``chunked`` makes one folder per ``chunk_id``."""
    if chunked:
        text = as_text(df.drop(CHUNK)).columns
        body = df.select([F.col(quoted(c)).cast("string").alias(c) for c in text] + [F.col(CHUNK)])
    else:
        body = as_text(df)
    if settings.escape_breaks:
        body = escape_breaks(body)
    writer = body.write.mode("overwrite").options(**_options(settings))
    if max_rows:
        writer = writer.option("maxRecordsPerFile", max_rows)
    if settings.compression:
        writer = writer.option("compression", settings.compression)
    if chunked:
        writer = writer.partitionBy(CHUNK)
    writer.csv(path)


def header_of(spark: SparkSession, path: str, settings: Settings, multi_line: bool = False) -> list[str]:
    """Column names of the first file's header line."""
    return _reader(spark, settings, multi_line).csv(path).drop(CHUNK).columns


def _reader(spark: SparkSession, settings: Settings, multi_line: bool):
    return (
        spark.read.options(**_options(settings))
        .option("recursiveFileLookup", "true")
        .option("multiLine", str(multi_line).lower())
    )


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    settings: Settings,
    columns: list[str] | None = None,
    multi_line: bool = False,
    checked: bool = True,
) -> DataFrame:
    """All cells as text under the header's names, and the raw line of malformed rows
    in ``RAW``.

    Files whose header differs from ``columns`` (default: the first file's) fail
    the read rather than being bound by position. Stray quotes inside a cell stay.
    ``checked=False`` leaves out the look for the path.
    """
    first = path if isinstance(path, str) else path[0]
    if checked and not path_exists(spark, first):
        raise MissingInput(f"no files to load: {first} does not exist")
    names = columns or header_of(spark, first, settings, multi_line)
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in names] + [T.StructField(RAW, T.StringType())]
    )
    return _reader(spark, settings, multi_line).options(**parse_options(settings)).schema(schema).csv(path)


def parse_options(settings: Settings) -> dict[str, str]:
    """Reader options that keep malformed lines apart instead of bending them into shape."""
    return {
        **_options(settings),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": RAW,
        "enforceSchema": "false",
        # With pruning, lines of the wrong width would pass unnoticed.
        "columnPruning": "false",
        "unescapedQuoteHandling": "STOP_AT_DELIMITER",
    }


def convert(cell: Column, dtype: T.DataType) -> Column:
    return cell if isinstance(dtype, T.StringType) else cell.try_cast(dtype)


@dataclass(frozen=True)
class Loaded:
    """Rows of one load before the split: typed columns, ``bad_reason`` and ``bad_line``."""

    rows: DataFrame
    schema: T.StructType

    def good(self, *carried: str) -> DataFrame:
        return self.rows.where(F.col(REASON).isNull()).select(*[quoted(n) for n in self.schema.names], *carried)

    def bad(self, *carried: str) -> DataFrame:
        """The quarantine: why a line was refused, and the line."""
        return self.rows.where(F.col(REASON).isNotNull()).select(REASON, LINE, *carried)


def conform(
    text: DataFrame,
    schema: T.StructType,
    separator: str = "\t",
    load_time_col: str | None = None,
    escaped: bool = False,
    carried: tuple[str, ...] = (),
) -> Loaded:
    """Type text rows to the target schema, by name and without case.

    A cell that is not NULL but cannot be read as its type makes a bad row, as
    does a malformed line. NUL characters are removed first; line breaks come back
    if they are ``escaped``. Target columns that the files lack become NULL, or make
    every row bad if they may not be NULL; ``load_time_col`` then gets the time of the load, as a column default would.
    Columns of ``text`` named in ``carried`` are no cells; they stay beside the row.
    """
    cells = [c for c in text.columns if c != RAW and c not in carried]
    clean = scrub_nul(text)
    found = {c.lower(): c for c in cells}
    typed, misfits, absent = [], [], []
    for field in schema.fields:
        name = found.get(field.name.lower())
        if name is None:
            absent_value = F.current_timestamp() if field.name == load_time_col else F.lit(None)
            cell = value = absent_value.cast(field.dataType)
        else:
            cell = F.col(quoted(name))
            value = convert(cell, field.dataType)
            if isinstance(field.dataType, T.StringType):
                value = unescape_breaks(cell) if escaped else cell
            else:
                misfits.append(
                    F.when(cell.isNotNull() & value.isNull(), F.lit(field.name))
                )
        if not field.nullable:
            absent.append(F.when(cell.isNull(), F.lit(field.name)))
        typed.append(value.alias(field.name))
    raw = F.col(RAW) if RAW in text.columns else F.lit(None).cast("string")
    wrong_type = F.concat(F.lit("not of its type: "), F.coalesce(*misfits)) if misfits else F.lit(None)
    missing = F.concat(F.lit("no value: "), F.coalesce(*absent)) if absent else F.lit(None)
    reason = F.coalesce(
        F.when(raw.isNotNull(), F.lit("malformed line")), wrong_type, missing
    ).cast("string")
    joined = F.concat_ws(
        separator, *[F.coalesce(F.col(quoted(c)), F.lit("")) for c in cells]
    )
    rows = clean.select(*typed, *carried, reason.alias(REASON), F.coalesce(raw, joined).alias(LINE))
    return Loaded(rows, schema)


def load_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    settings: Settings,
    multi_line: bool = False,
    load_time_col: str | None = None,
) -> Loaded:
    """Read and conform in one plan; the caller decides what the bad rows mean."""
    text = read_delimited(spark, path, settings, multi_line=multi_line)
    return conform(text, schema, settings.separator, load_time_col, settings.escape_breaks)


def write_counting_bad(loaded: Loaded, path: str, by: str | None = None) -> int:
    """Write the good rows to ``path`` and return how many bad ones were met, in one pass.

    With the carried column ``by`` they are added to ``path``, in a folder for each of its values.
    """
    seen = Observation()
    # Columns are not pruned through the count, so the line is left out before it.
    watched = Loaded(loaded.rows.drop(LINE).observe(
        seen, F.count_if(F.col(REASON).isNotNull()).alias("bad")
    ), loaded.schema)
    if by is None:
        watched.good().write.mode("overwrite").parquet(path)
    else:
        watched.good(by).write.mode("append").partitionBy(by).parquet(path)
    return seen.get["bad"]


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """Lines per export file (header lines included), gzip or plain."""
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    return lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("lines")
    )


def total_lines(counts: DataFrame) -> DataFrame:
    """All files of ``line_counts`` together."""
    return counts.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("lines"), F.lit(0)).alias("lines")
    )


def chunk_of(file: Column) -> Column:
    """The chunk id in a file's folder name."""
    return F.regexp_extract(file, rf"{CHUNK}=(-?\d+)", 1).cast("int")


