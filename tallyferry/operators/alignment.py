"""Cell differences of two tables without a key, where rows may be missing on either side.

Rows that both sides hold equally often cancel out first, in one aggregate. Only the
leftovers are paired: rows that agree in all columns but one, then in all but two. A
leftover is entered under its digest without each such set of columns; under every
entry the sources and targets are seated in order and the first meets the first,
so no pair but these is ever formed. A row takes its best seat (fewest columns left out,
the first of them), and the rest is seated again until nobody meets. One missing row is
one line, wherever it stood.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.functions.digests import comparable, row_text
from tallyferry.functions.text import quoted
from tallyferry.operators.diffs import multiset_diff
from tallyferry.operators.ordering import number_rows
from tallyferry.session import materialise

#: Cells in which two rows may differ and still be one changed row.
MAX_CHANGED = 2


def aligned_diff(
    source: DataFrame, target: DataFrame, show: Sequence[str] | None = None, max_changed: int = MAX_CHANGED
) -> DataFrame:
    """Differing cells: *show* (or ``row_digest``), ``column_name``, ``source_value``,
    ``target_value``, ``kind`` and ``copies``, the number of times a line is met.

    ``show`` names columns whose values tell a row: the source's, for a target-only row
    its own. A row without a partner gives one line of kind ``source_only`` or
    ``target_only`` without a column name; rows that differ in more than ``max_changed``
    cells are such rows on both sides. Copies of a row are rows of their own.
    """
    columns = source.columns
    if {"side", "copies"} & set(columns):
        raise ValueError("columns named 'side' or 'copies' stand for the comparison: rename them first")
    surplus = multiset_diff(source, target)
    here = F.col("side") == "source"
    rows = materialise(
        surplus.select(
            F.md5(row_text(columns)).alias("rid"), here.alias("here"), F.col("copies"),
            F.struct(*[F.col(quoted(c)) for c in columns]).alias("row"), F.array(*_cells(source, columns)).alias("cells"),
        ),
        "surplus",
    )
    units = rows.select("rid", "here", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("occ"), "cells")
    pairs, alone = _paired(units, len(columns), max_changed)
    return _lines(rows, pairs, alone, source, show)


def _cells(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """A digest of each cell that knows its column; NULL is a value of its own."""
    out = []
    for number, name in enumerate(columns):
        cell = comparable(name, df.schema[name].dataType)
        out.append(F.expr(f"xxhash64({number}, isnull({quoted(name)}), {cell})"))
    return out


def _entries(changed: int) -> Column:
    """Per set of ``changed`` columns: its first and last number and the row's digest without them."""
    whole = "aggregate(cells, 0L, (a, c) -> a ^ c)"
    if changed == 1:
        sets = f"transform(cells, (c, i) -> struct(i as a, i as b, {whole} ^ c as rest))"
    else:
        sets = (
            "flatten(transform(sequence(0, size(cells) - 2), i -> transform(sequence(i + 1, size(cells) - 1), "
            f"j -> struct(i as a, j as b, {whole} ^ cells[i] ^ cells[j] as rest))))"
        )
    return F.inline(F.expr(sets))


def _paired(units: DataFrame, width: int, max_changed: int) -> tuple[DataFrame | None, DataFrame]:
    """Pairs (rid, occ, other_rid, other_occ) and the units that stay alone."""
    if not 0 <= max_changed <= 2:
        raise ValueError("rows are paired when at most two of their cells differ")
    pairs = None
    alone = materialise(units, "alone")
    for changed in range(1, min(max_changed, width - 1) + 1):
        while True:
            shared = materialise(_shared_entries(alone, changed), "shared")
            if shared.isEmpty():
                break
            met = materialise(_meetings(shared, changed), "met")
            if met.isEmpty():
                break
            pairs = met if pairs is None else pairs.union(met)
            taken = met.selectExpr("rid", "true as here", "occ").union(met.selectExpr("other_rid", "false", "other_occ"))
            alone = materialise(alone.join(taken, ["rid", "here", "occ"], "left_anti"), "alone")
    return pairs, alone


_ENTRY = ["a", "b", "rest"]


def _shared_entries(units: DataFrame, changed: int) -> DataFrame:
    """The entries of units under which both sides stand; really missing rows have none."""
    entered = units.select("rid", "here", "occ", "cells", _entries(changed))
    sides = entered.groupBy(*_ENTRY).agg(F.min("here").alias("first"), F.max("here").alias("last"))
    return entered.join(sides.where("first <> last").select(*_ENTRY), _ENTRY, "left_semi")


def _meetings(shared: DataFrame, changed: int) -> DataFrame:
    """Who meets at this number of changed cells: each unit at most once, on its best entry."""
    entry = _ENTRY
    numbered = number_rows(shared, [*entry, "here", "rid", "occ"], "place")
    starts = numbered.groupBy(*entry, "here").agg(F.min("place").alias("start"))
    seated = numbered.join(starts, [*entry, "here"]).withColumn("seat", F.col("place") - F.col("start"))
    sources = seated.where("here").select(*entry, "seat", "rid", "occ", "cells")
    targets = seated.where("not here").select(
        *entry, "seat", F.col("rid").alias("other_rid"), F.col("occ").alias("other_occ"), F.col("cells").alias("other_cells")
    )
    differ = "size(filter(zip_with(cells, other_cells, (x, y) -> x <> y), d -> d))"
    best = F.struct("a", "b", "rid", "occ", "other_rid", "other_occ")
    proposed = sources.join(targets, [*entry, "seat"]).where(f"{differ} <= {changed}").groupBy("rid", "occ").agg(F.min(best).alias("best"))
    answered = proposed.groupBy("best.other_rid", "best.other_occ").agg(F.min("best").alias("best"))
    return answered.select("best.rid", "best.occ", "best.other_rid", "best.other_occ")


def _lines(rows: DataFrame, pairs: DataFrame | None, alone: DataFrame, like: DataFrame, show: Sequence[str] | None) -> DataFrame:
    """The result's lines; equal ones are counted before any row is fetched."""
    nothing = F.lit(None).cast("string")
    told = [F.col(f"row.{quoted(c)}").alias(c) for c in show] if show is not None else [F.col("rid").alias("row_digest")]
    names = list(show) if show is not None else ["row_digest"]
    lone = alone.groupBy("rid", "here").agg(F.count(F.lit(1)).alias("times")).join(rows, ["rid", "here"]).select(
        *told, nothing.alias("column_name"), nothing.alias("source_value"), nothing.alias("target_value"),
        F.when(F.col("here"), "source_only").otherwise("target_only").alias("kind"), "times",
    )
    out = lone
    if pairs is not None:
        counted = pairs.groupBy("rid", "other_rid").agg(F.count(F.lit(1)).alias("times"))
        left = rows.where("here").select("rid", "row")
        right = rows.where("not here").select(F.col("rid").alias("other_rid"), F.col("row").alias("other"))
        cells = []
        for name in like.columns:
            mine, theirs = F.col(f"row.{quoted(name)}"), F.col(f"other.{quoted(name)}")
            compared = [F.expr(comparable(name, like.schema[name].dataType).replace(quoted(name), f"{s}.{quoted(name)}")) for s in ("row", "other")]
            cells.append(F.struct(
                F.lit(name).alias("column_name"), mine.cast("string").alias("source_value"),
                theirs.cast("string").alias("target_value"), (~compared[0].eqNullSafe(compared[1])).alias("keep"),
            ))
        differing = F.filter(F.array(*cells), lambda cell: cell["keep"])
        changed = counted.join(left, "rid").join(right, "other_rid").select(*told, "times", F.inline(differing))
        out = out.unionByName(changed.select(*map(quoted, names), "column_name", "source_value", "target_value", F.lit("changed").alias("kind"), "times"))
    keys = [*names, "column_name", "source_value", "target_value", "kind"]
    return out.groupBy(*map(quoted, keys)).agg(F.sum("times").alias("copies"))
