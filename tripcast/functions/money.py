"""Money expressions that give the same digits on every run.

Sums of doubles depend on the order partitions are combined in; money is
stored as DECIMAL(12,2) and summed exactly, then turned into a double once.
An average of money is that exact sum divided by the number of non-NULL
inputs.  Other numbers are averaged as the doubles they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(c: str | Column) -> Column:
    """sum() of a MONEY column, exact, as double."""
    return F.sum(_c(c).cast("decimal(20,2)")).cast("double")


def exact_avg(c: str | Column) -> Column:
    """avg() of a MONEY column with an exact numerator; numerator and count
    are taken of the same expression."""
    x = _c(c).cast("decimal(20,2)")
    return F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double"))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(num, den)
