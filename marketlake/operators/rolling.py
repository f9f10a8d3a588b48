"""Returns and rolling means of fixed-point values.

A sliding frame is evaluated from scratch for every row, so its cost grows with the frame. On
fixed-point input running sums are exact integers, and the difference of two of them gives the sums
of any frame at constant cost per row. Results are rounded once, half away from zero.

Short decimals are counted in longs, wider ones in decimals of 38 digits, with the same results; a sum beyond 38 digits
is an error, never a wrong number.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACES = 6
#: Up to this precision every intermediate sum fits a long, up to the other one it fits 38 digits.
LONG_PRECISION, MAX_PRECISION = 9, 24
WHOLE = "decimal(38,0)"


def fixed_point(dtype: T.DataType) -> bool:
    """Decimals that are computed exactly."""
    return isinstance(dtype, T.DecimalType) and dtype.precision <= MAX_PRECISION and dtype.scale <= PLACES


def units(value: Column, dtype: T.DecimalType) -> Column:
    """A decimal as a whole number of its smallest unit."""
    return (value * 10**dtype.scale).cast("long" if dtype.precision <= LONG_PRECISION else WHOLE)


def quotient(top: Column, bottom: Column, dtype: T.DecimalType) -> Column:
    """``top / bottom`` of whole numbers in units of ``10 ** -PLACES``, rounded half away from zero."""
    if dtype.precision <= LONG_PRECISION:
        size = F.call_function("div", 2 * F.abs(top) * 10**PLACES + F.abs(bottom), 2 * F.abs(bottom))
    else:
        over = (F.abs(top).cast(WHOLE) * (2 * 10**PLACES) + F.abs(bottom).cast(WHOLE)).cast(WHOLE)
        under = (F.abs(bottom).cast(WHOLE) * 2).cast(WHOLE)
        size = ((over - over % under).cast(WHOLE) / under).cast(WHOLE)  # the remainder is taken off first: no rounding
    return F.when((top < 0) == (bottom < 0), size).otherwise(-size)


def from_units(value: Column) -> Column:
    return value.cast("double") / F.lit(float(10**PLACES))


def returns(price: Column, previous: Column, dtype: T.DecimalType) -> Column:
    """Relative change of two fixed-point prices; NULL without a usable previous price."""
    now, before = units(price, dtype), units(previous, dtype)
    return F.when(before != 0, from_units(quotient(now - before, before, dtype)))


def running_totals(column: str, dtype: T.DecimalType, w: WindowSpec) -> dict[str, Column]:
    """Sum and count of ``column`` up to each row, as ``_sum`` and ``_n``."""
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return {"_sum": F.sum(units(F.col(column), dtype)).over(run), "_n": F.count(column).over(run)}


def totals_before(rows: int, w: WindowSpec) -> dict[str, Column]:
    """The running totals ``rows`` rows earlier."""
    return {"_sum_before": F.lag("_sum", rows).over(w), "_n_before": F.lag("_n", rows).over(w)}


def frame_mean(dtype: T.DecimalType) -> Column:
    """Mean of the frame between the two totals, NULLs skipped."""
    total = F.col("_sum") - F.coalesce("_sum_before", F.lit(0))
    count = F.col("_n") - F.coalesce("_n_before", F.lit(0))
    return F.when(count > 0, from_units(quotient(total, count * 10**dtype.scale, dtype)))


HELPERS = ("_sum", "_n", "_sum_before", "_n_before")
