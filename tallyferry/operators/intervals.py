"""Which interval between sorted cut values a value lies in."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to this many cuts a nested CASE stays small enough for the JIT compiler.
CASE_CUTS = 64


def halving_case(value: Column, cuts: Sequence[Column], low: int, high: int) -> Column:
    """Binary search as nested CASE: log2(cuts) comparisons per row, in codegen."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value < cuts[middle], halving_case(value, cuts, low, middle)).otherwise(
        halving_case(value, cuts, middle + 1, high)
    )


def between_cuts(value: Column, cuts: Sequence[object]) -> Column:
    """How many of the sorted ``cuts`` lie at or below a non-null value."""
    if len(cuts) <= CASE_CUTS:
        return halving_case(value, [F.lit(c) for c in cuts], 0, len(cuts))
    return search_cuts(value, cuts)


def is_cut(value: Column, cuts: Sequence[object], below: Column) -> Column:
    """Whether a non-null value is one of the sorted ``cuts``, ``below`` of which lie at or below it."""
    if len(cuts) <= CASE_CUTS:
        return value.isin(list(cuts))
    return F.coalesce(F.get(constant_array(cuts), below - 1) == value, F.lit(False))


def search_cuts(value: Column, cuts: Sequence[object]) -> Column:
    """Binary search over a constant array, for many cuts: log2(cuts) steps a row and no Python worker.

    A NULL value lies above no cut. Being never NULL, the number is not looked for twice by inferred filters.
    """
    known = constant_array(cuts)
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]

    def place(given: Column) -> Column:
        return F.aggregate(
            F.array(*[F.lit(s) for s in steps]), F.lit(0),
            lambda at, step: F.when(F.get(known, at + step - 1) <= given, at + step).otherwise(at),
        )

    # An array of one: the value is computed once, not in every step.
    return F.coalesce(F.get(F.transform(F.array(value), place), F.lit(0)), F.lit(0))


def constant_array(values: Sequence[object]) -> Column:
    """Whole numbers, floats, decimals or texts as one array literal, made from one text."""
    first = values[0]
    if isinstance(first, str):
        # A character that no value holds.
        used = set().union(*values)
        mark = next(c for c in map(chr, range(1, 0xD800)) if c not in used and c not in "\\^$.|?*+()[]{}")
        return F.split(F.lit(mark.join(values)), mark)
    if isinstance(first, Decimal):
        scale = max(0, -min(v.as_tuple().exponent for v in values))
        element = f"decimal(38,{scale})"
    else:
        element = "double" if isinstance(first, float) else "bigint"
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{element}>")
