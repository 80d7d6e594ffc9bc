"""Cleaning of text cells before they are written or after they are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def quoted(name: str) -> str:
    """A column name safe to pass to ``F.col``, reserved words and dots included."""
    return "`" + name.replace("`", "``") + "`"


def scrub_nul(df: DataFrame) -> DataFrame:
    """Remove NUL characters from every text column.

    The byte search spares the clean cells, nearly all of them, the slower translation.
    """
    nul = "\u0000"
    return _on_text(
        df, lambda c: F.when(F.contains(c, F.lit(nul)), F.translate(c, nul, "")).otherwise(c)
    )


def escape_breaks(df: DataFrame) -> DataFrame:
    """Line breaks and backslashes of every text column as backslash escapes."""

    def escaped(cell: Column) -> Column:
        out = F.replace(cell, F.lit("\\"), F.lit("\\\\"))
        out = F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
        return F.when(F.rlike(cell, F.lit(r"[\\\n\r]")), out).otherwise(cell)

    return _on_text(df, escaped)


def unescape_breaks(cell: Column) -> Column:
    """What ``escape_breaks`` made of a cell, back again; a backslash before anything else stays."""
    # Between escaped backslashes, a backslash can only belong to a line break.
    parts = F.transform(
        F.split(cell, r"\\\\"),
        lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")),
    )
    return F.when(F.contains(cell, F.lit("\\")), F.array_join(parts, "\\")).otherwise(cell)


def quote_json_cells(df: DataFrame) -> DataFrame:
    """Wrap cells that hold a JSON object in single quotes, as the loader needs."""
    return _on_text(df, lambda c: F.regexp_replace(c, r"(?s)\A(\{.*\})\z", "'$1'"))


def quote_json_lines(line: Column, separator: str = "\t") -> Column:
    """The same for a raw delimited line: a quote after the separator before ``{``,
    and one between ``}`` and the next separator."""
    opened = F.replace(line, F.lit(separator + "{"), F.lit(separator + "'{"))
    return F.replace(opened, F.lit("}" + separator), F.lit("}'" + separator))


def _on_text(df: DataFrame, change) -> DataFrame:
    names = set(text_columns(df))
    return df.select(
        [
            change(F.col(quoted(c))).alias(c) if c in names else F.col(quoted(c))
            for c in df.columns
        ]
    )
