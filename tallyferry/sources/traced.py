"""Delimited text whose bad rows are told by file and line.

Lines are read as text, numbered inside the split that read them, parsed and typed in
one pass, and written once with their split. The lines of the splits before it in the
same file are added afterwards, from one small row per split. So files may be split, and
tasks run again, and a line still has the number that an editor shows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyferry.functions.text import quoted
from tallyferry.session import materialise, path_exists
from tallyferry.sources.delimited import LINE, RAW, REASON, conform, header_of, parse_options
from tallyferry.specs import MissingInput, Settings

FILE, LINE_NUMBER = "bad_file", "bad_line_number"
_TEXT, _CELLS, _BLOCK, _AT, _KIND = "__text", "__cells", "__block", "__at", "__kind"
_DATA, _LIKE_HEADER, _BLANK = 0, 1, 2


def lines_below(reader, path: str | list[str]) -> DataFrame:
    """Every line of the files below ``path``, its file and where its split starts.

    ``reader`` is ``spark.read`` or ``spark.readStream``.
    """
    text = reader.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    return text.select(
        F.col("value").alias(_TEXT), F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(_BLOCK),
    )


@dataclass(frozen=True)
class Traced:
    """One load, parsed and written once: every line with its split, and one row per split."""

    lines: DataFrame
    splits: DataFrame
    schema: T.StructType

    def _rows(self) -> DataFrame:
        # Only the first line of a file is its header; others may look like it.
        heads = self.splits.select(FILE, _BLOCK, "head")
        alike = self.lines.where(F.col(_KIND) == _LIKE_HEADER).join(heads, [FILE, _BLOCK])
        alike = alike.where(F.col(_AT) != F.col("head")).select(*[quoted(c) for c in self.lines.columns])
        return self.lines.where(F.col(_KIND) == _DATA).union(alike)

    def good(self) -> DataFrame:
        return self._rows().where(F.col(REASON).isNull()).select(*[quoted(n) for n in self.schema.names])

    def bad(self) -> DataFrame:
        """The quarantine: why a line was refused, the line, its file and its number there, from 1."""
        number = F.col("before") + F.col(_AT) - F.col("first") + 1
        bad = self._rows().where(F.col(REASON).isNotNull()).select(REASON, LINE, FILE, _BLOCK, _AT)
        return bad.join(self.splits, [FILE, _BLOCK]).select(REASON, LINE, FILE, number.alias(LINE_NUMBER))

    def count_bad(self) -> int:
        return self._rows().where(F.col(REASON).isNotNull()).count()


def stage_traced(
    lines: DataFrame, header: list[str], schema: T.StructType, settings: Settings, load_time_col: str | None = None
) -> Traced:
    """Parse, type and write the lines of ``lines_below`` in one pass.

    ``header`` names the cells in file order; a file whose first line that is not blank
    is another fails the load. Blank lines are counted but are no rows.
    """
    numbered = lines.withColumn(_AT, F.monotonically_increasing_id())
    cells = ", ".join(f"{quoted(n)} string" for n in [*header, RAW])
    split = numbered.withColumn(_CELLS, F.from_csv(_TEXT, cells, parse_options(settings)))
    names = [F.lower(F.col(_CELLS).getField(n)).eqNullSafe(F.lit(n.lower())) for n in header]
    kind = (
        F.when(~F.col(_TEXT).rlike(r"[^\x00-\x20]"), _BLANK)
        .when((F.col(_BLOCK) == 0) & reduce(and_, names), _LIKE_HEADER)
        .otherwise(_DATA)
    )
    carried = (FILE, _BLOCK, _AT, _KIND)
    text = split.select(f"{_CELLS}.*", FILE, _BLOCK, _AT, kind.alias(_KIND))
    loaded = conform(text, schema, settings.separator, load_time_col, settings.escape_breaks, carried)
    # The line itself is only kept where it is refused.
    refused = F.when(F.col(REASON).isNotNull(), F.col(LINE))
    staged = materialise(loaded.rows.withColumn(LINE, refused), "traced")

    line = F.when(F.col(_KIND) != _BLANK, F.col(_AT))
    earlier = Window.partitionBy(FILE).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        staged.groupBy(FILE, _BLOCK)
        .agg(
            F.min(_AT).alias("first"), F.count(F.lit(1)).alias("n"), F.min(line).alias("head"),
            F.min_by(_KIND, line).alias("head_kind"),
        )
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    )
    splits = materialise(splits, "splits")
    other = splits.where((F.col(_BLOCK) == 0) & (F.col("head_kind") != _LIKE_HEADER)).select(FILE).first()
    if other is not None:
        raise ValueError(f"{other[0]}: its header is not {settings.separator.join(header)!r}")
    return Traced(staged, splits.select(FILE, _BLOCK, "first", "head", "before"), schema)


def load_traced(
    spark: SparkSession, path: str, schema: T.StructType, settings: Settings, load_time_col: str | None = None
) -> Traced:
    """``load_delimited`` for files whose bad rows have to be found again; cells hold no line breaks."""
    if not path_exists(spark, path):
        raise MissingInput(f"no files to load: {path} does not exist")
    header = header_of(spark, path, settings)
    return stage_traced(lines_below(spark.read, path), header, schema, settings, load_time_col)
