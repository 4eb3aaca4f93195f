"""Number expressions with the rounding rules the results are defined by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fraction of a double scaled by 2**57 is a whole number as soon as the
# double is at least 1/32, and ten times that still fits a long.
_BITS = 57


def tenths(value: Column) -> Column:
    """Round to one decimal on the exact binary value, exact ties to even.

    ``bround`` works on the shortest decimal text of the double, so 20.15
    becomes 20.2 although the stored number is below the tie. Here the fraction
    is compared with the tie in whole numbers: no error, no BigDecimal, and
    code generation all the way. Valid for magnitudes below 2**53; NaN and
    infinity stay as they are.
    """
    size = F.abs(value)
    fraction = size % F.lit(1.0)
    scaled = (fraction * F.lit(float(1 << _BITS))).cast("long") * F.lit(10)
    odd = F.shiftright(scaled, _BITS).bitwiseAND(F.lit(1))
    # Just below half, plus one if the digit is odd: only then does a tie carry.
    carried = scaled + F.lit((1 << (_BITS - 1)) - 1) + odd
    rounded = F.floor(size) * 10 + F.shiftright(carried, _BITS)
    tenth = F.signum(value) * rounded.cast("double") / F.lit(10.0)
    return F.when(F.isnan(value) | (size == float("inf")), value).otherwise(tenth)


def half_up(value: Column) -> Column:
    """Round to a whole number, ties upwards."""
    return F.floor(value + F.lit(0.5)).cast("int")


def or_default(value: Column, default: Column | float) -> Column:
    """``default`` where ``value`` is null or zero."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(value, F.lit(0.0)), fallback)
