"""Rounding and division with fixed, documented rules.

Spark's own ``round``/``bround`` work on the shortest decimal text of a double; the
results to be matched were made by binary arithmetic.  They differ on ties such as
1.005, hence the three helpers.  Each uses its argument several times: give it a column
of an earlier projection or an aggregate, not a long expression that would be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Splits a 53-bit double into two halves whose product with a small integer is exact.
_SPLITTER = float(2**27 + 1)


def round_half_away(value: Column, digits: int) -> Column:
    """Scale, round half away from zero, scale back.  Used where the rule is SQL ROUND."""
    unit = float(10**digits)
    scaled = F.abs(value) * unit
    even = F.rint(scaled)
    # Rounding half to even went down exactly where half a unit is left.
    nearest = even + F.when(scaled - even == 0.5, 1.0).otherwise(0.0)
    return F.signum(value) * nearest / unit


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round half to even, scale back.  Used where the rule is a dataframe's round."""
    unit = float(10**digits)
    return F.rint(value * unit) / unit


def round_exact(value: Column, digits: int) -> Column:
    """Nearest multiple of 10^-digits to the *exact* binary value, ties to even.

    Scaling can land on a false tie (2.45 * 10 = 24.5 although the double 2.45 lies
    above 2.45).  The product's rounding error, recovered by splitting the operand,
    decides those.
    """
    unit = float(10**digits)
    scaled = value * unit
    carried = value * _SPLITTER
    high = carried - (carried - value)
    error = (high * unit - scaled) + (value - high) * unit
    tie = F.abs(scaled - F.rint(scaled)) == 0.5
    return F.rint(scaled + F.when(tie, F.signum(error) * 0.25).otherwise(0.0)) / unit


def ieee_divide(numerator: Column, denominator: Column) -> Column:
    """Double division where x/0 is +-infinity and 0/0 is NaN instead of an error."""
    top, bottom = numerator.cast("double"), denominator.cast("double")
    return F.when(bottom == 0, top * float("inf")).otherwise(F.try_divide(top, bottom))


def exact_mean(value: Column) -> Column:
    """Aggregate: mean of doubles that does not depend on the order of summation.

    Values are summed as decimals of six digits, and the sum is divided once.  A column with
    values that such a decimal cannot hold (not finite, or 10^12 and more) gets the plain mean.
    """
    decimal = value.try_cast("decimal(18,6)")
    mean = F.sum(decimal).cast("double") / F.nullif(F.count(value), F.lit(0))
    return F.when(F.count(value) == F.count(decimal), mean).otherwise(F.avg(value))


def percent_true(flag: Column) -> Column:
    """Aggregate: share of true values in percent, one decimal."""
    return round_half_away(F.avg(flag.cast("int")) * 100, 1)


def percent_mean(fraction: Column) -> Column:
    """Aggregate: mean of a 0..1 score in percent, one decimal."""
    return round_half_away(exact_mean(fraction) * 100, 1)
