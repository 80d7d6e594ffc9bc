"""Order-free exact sums of integers that cannot overflow at warehouse scale."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bits per limb and number of limbs that hold a value of the type.
_LIMBS = {T.LongType: (22, 3), T.IntegerType: (16, 2)}


def exact_sum(value: str, dtype: T.DataType) -> Column:
    """Sum of an integral or decimal SQL expression as an exact decimal; NULL counts as 0."""
    return F.expr(exact_sum_sql(value, dtype))


def exact_sum_sql(value: str, dtype: T.DataType) -> str:
    """The same as SQL text, which builds wide aggregates with few calls to the JVM.

    A long is summed as three 22-bit limbs in plain long arithmetic, exact up to
    2**41 rows and quicker than casting every row to decimal; an int as two. The sum
    of decimals of more than 28 digits may not fit a decimal: their fraction (to 18
    places) and two limbs of the integer part are summed exactly and given as a double.
    """
    if isinstance(dtype, T.DecimalType) and dtype.precision > 28:
        whole = f"cast(if({value} < 0, ceil({value}), floor({value})) as decimal(38,0))"
        limb = "cast(100000000000000 as decimal(15,0))"
        low = f"({whole} % {limb})"
        high = f"cast(({whole} - {low}) / {limb} as decimal(24,0))"
        fraction = f"cast({value} - {whole} as decimal(19,18))"
        parts = [f"cast(sum({high}) as double) * 1e14", f"cast(sum(cast({low} as decimal(15,0))) as double)"]
        if dtype.scale:
            parts.append(f"cast(sum({fraction}) as double)")
        return f"coalesce({' + '.join(parts)}, 0)"
    if isinstance(dtype, T.DecimalType):
        return f"coalesce(sum({value}), cast(0 as {dtype.simpleString()}))"
    if isinstance(dtype, (T.ByteType, T.ShortType)):
        return f"cast(coalesce(sum(cast({value} as bigint)), 0) as decimal(38,0))"
    bits, count = _LIMBS[type(dtype)]
    parts = []
    for i in range(count):
        limb = f"shiftright({value}, {i * bits})" if i else value
        if i < count - 1:
            limb = f"({limb} & {(1 << bits) - 1})"
        # decimal(19,0) * decimal(18,0) stays within 38 digits, hence exact.
        total = f"cast(sum(cast({limb} as bigint)) as decimal(19,0))"
        parts.append(f"{total} * cast({1 << (i * bits)} as decimal(18,0))")
    return f"coalesce(cast({' + '.join(parts)} as decimal(38,0)), cast(0 as decimal(38,0)))"
