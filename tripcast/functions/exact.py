"""Sums and averages of doubles that do not depend on the order of summing.

A double is taken apart into whole units and a fraction in units of 2^-62, two
integers; integers are summed exactly (as decimals) in any order, so any
partitioning gives the same bits.  The exact total is turned into a double
once, correctly rounded.  A fraction below 2^-62 is cut, for each value alike.
Two such pairs of sums add up, which makes them fit for partial aggregates that
are stored and merged later.

A group that holds NaN, an infinity or a number of 2^62 or more gets the
ordinary sum of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = float(1 << 62)
_INT = "decimal(20,0)"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _odd(x: Column) -> Column:
    return F.isnan(x) | (F.abs(x) >= UNIT)


def whole_and_fraction(c: str | Column) -> tuple[Column, Column]:
    """The two integers of a double, NULL for NULL and for numbers beyond the range."""
    x = F.when(~_odd(_c(c)), _c(c).cast("double"))
    whole = F.floor(x)
    return whole, F.floor((x - whole.cast("double")) * UNIT)


def partial_sums(c: str | Column) -> tuple[Column, Column, Column]:
    """Aggregates of a double column that can be summed again: whole units,
    fractions, and the plain sum of the numbers beyond the range (NULL if none)."""
    whole, fraction = whole_and_fraction(c)
    return (F.sum(whole.cast(_INT)), F.sum(fraction.cast(_INT)),
            F.sum(F.when(_odd(_c(c)), _c(c).cast("double"))))


def merged(whole: Column, fraction: Column, odd: Column) -> Column:
    """The double that summed parts stand for."""
    total = whole.cast("decimal(38,0)") * F.lit(1 << 62).cast(_INT) + fraction.cast("decimal(38,0)")
    exact = F.when(F.abs(whole) < F.lit(1 << 62), total.cast("double") / UNIT).otherwise(whole.cast("double"))
    return F.when(odd.isNull(), exact).otherwise(odd + whole.cast("double"))


def exact_double_sum(c: str | Column) -> Column:
    """sum() of a double column, the same bits under any partitioning."""
    whole, fraction, odd = partial_sums(c)
    return F.when(odd.isNull(), merged(whole, fraction, odd)).otherwise(F.sum(_c(c).cast("double")))


def exact_double_avg(c: str | Column) -> Column:
    """avg() of a double column: the exact sum over the count of non-NULL values."""
    return F.try_divide(exact_double_sum(c), F.count(_c(c)).cast("double"))
