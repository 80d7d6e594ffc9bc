"""Small scalar expressions used around a move."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyferry.functions.text import quoted

_SECONDS_PER_WEEK = 604800
_STAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"


def naive_micros(stamp: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session zone."""
    days = F.unix_date(stamp.cast("date")).cast("bigint")
    minutes = days * 1440 + F.hour(stamp) * 60 + F.minute(stamp)
    seconds = F.extract(F.lit("SECOND"), stamp)
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from one wall-clock time to another."""
    span = naive_micros(end.cast("timestamp_ntz")) - naive_micros(start.cast("timestamp_ntz"))
    return span / F.lit(1_000_000)


def weeks_between(start: Column, end: Column) -> Column:
    """Length of a window in weeks, fractions included."""
    return seconds_between(start, end) / F.lit(_SECONDS_PER_WEEK)


def is_timestamp_text(text: Column) -> Column:
    """Whether text is a valid ``YYYY-MM-DD HH:MM:SS``."""
    return F.try_to_timestamp(text, F.lit(_STAMP_PATTERN)).isNotNull()


def day_of(column: Column) -> Column:
    return column.cast("date")


def megabytes(size: Column, digits: int) -> Column:
    return F.round(size.cast("double") / F.lit(1024.0 * 1024.0), digits)


def ordinal(df: DataFrame, column: str) -> Column:
    """The column as a number (or text) with the same order, for Arrow transfer."""
    col, dtype = F.col(quoted(column)), df.schema[column].dataType
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("bigint")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.TimestampNTZType):
        return naive_micros(col)
    if dtype.typeName().startswith("time("):
        seconds = F.hour(col) * 3600 + F.minute(col) * 60
        micros = (F.extract(F.lit("SECOND"), col) * 1_000_000).cast("bigint")
        return seconds.cast("bigint") * 1_000_000 + micros
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return col.cast("double")
    if isinstance(dtype, (T.StringType, T.DecimalType)):
        return col
    return col.cast("bigint")


def ordinal_literal(df: DataFrame, column: str, value: object) -> Column:
    """The column's own value whose ``ordinal`` this is; a constant, so filters with it stay pushable."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date(F.lit(value).cast("int"))
    if isinstance(dtype, T.TimestampType):
        # Not through text: an hour that a session zone repeats would be read as its first one.
        return F.timestamp_micros(F.lit(value))
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(str(datetime(1970, 1, 1) + timedelta(microseconds=value))).cast(dtype)
    if dtype.typeName().startswith("time("):
        return F.lit(str((datetime(1970, 1, 1) + timedelta(microseconds=value)).time())).cast(dtype)
    return F.lit(value).cast(dtype)
