"""Aggregates of trips that read a trip table and a trip summary alike.

A summary (``tripcast.operators.summary``) has one row per month, business, zone
pair and time of day with the number of trips and exact partial sums.  Each
measure below is an aggregate expression over either: counting rows of trips,
or summing the counts of a summary.  Both give the same digits, because every
partial sum is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcast.functions import exact

TRIPS = "n_trips"  # the column that tells a summary from trips
MONEY_MEASURES = ("passenger_fare", "driver_total_pay", "rideshare_profit")
DOUBLE_MEASURES = ("trip_length", "dollars_per_mile")


def is_summary(df: DataFrame) -> bool:
    return TRIPS in df.columns


def part(column: str, what: str) -> str:
    """Name of a summary column: sum of money, whole / fraction / odd part of a
    sum of doubles, or n, the number of values that are not NULL."""
    return f"{column}__{what}"


def partials(trips: DataFrame) -> list[Column]:
    """The aggregates that a summary stores."""
    out = [trips_in(trips).alias(TRIPS)]
    for c in MONEY_MEASURES:
        out += [money_total(trips, c).alias(part(c, "sum")), values_in(trips, c).alias(part(c, "n"))]
    for c in DOUBLE_MEASURES:
        parts = double_parts(trips, c)
        out += [x.alias(part(c, what)) for what, x in zip(("whole", "fraction", "odd"), parts)]
        out.append(values_in(trips, c).alias(part(c, "n")))
    return out


def trips_in(df: DataFrame) -> Column:
    """Number of trips."""
    return F.sum(TRIPS) if is_summary(df) else F.count(F.lit(1))


def trips_where(df: DataFrame, condition: Column) -> Column:
    """Number of trips for which a condition on grouping columns holds, 0 if none."""
    if is_summary(df):
        return F.coalesce(F.sum(F.when(condition, F.col(TRIPS))), F.lit(0)).cast("long")
    return F.count_if(condition)


def values_in(df: DataFrame, column: str) -> Column:
    """Number of trips with a value in ``column``."""
    return F.sum(part(column, "n")) if is_summary(df) else F.count(column)


def money_total(df: DataFrame, column: str) -> Column:
    """Exact sum of a money column, as a decimal."""
    if is_summary(df):
        return F.sum(part(column, "sum")).cast("decimal(38,2)")
    return F.sum(F.col(column).cast("decimal(20,2)")).cast("decimal(38,2)")


def money_sum(df: DataFrame, column: str) -> Column:
    """Exact sum of a money column, turned into a double once."""
    return money_total(df, column).cast("double")


def money_avg(df: DataFrame, column: str) -> Column:
    return F.try_divide(money_sum(df, column), values_in(df, column).cast("double"))


def double_parts(df: DataFrame, column: str) -> tuple[Column, Column, Column]:
    if is_summary(df):
        return tuple(F.sum(part(column, what)) for what in ("whole", "fraction", "odd"))
    return exact.partial_sums(column)


def double_avg(df: DataFrame, column: str) -> Column:
    """Average of doubles, the same bits under any partitioning."""
    total = exact.merged(*double_parts(df, column))
    return F.try_divide(total, values_in(df, column).cast("double"))
