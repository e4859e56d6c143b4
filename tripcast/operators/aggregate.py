"""Grouped aggregates over the trip table.

Every aggregate here is a single ``groupBy().agg()``: Spark plans it as a
partial (map-side) aggregate, one shuffle of at most one row per group and
task, and a final aggregate.  A key holding a third of all trips is therefore
folded inside each task before the shuffle and never becomes a hot partition.
Several measures over the same grouping are computed in the same pass instead
of one scan per measure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcast.functions import measures as ms
from tripcast.functions.calendar import day_of, month_of, year_month_of
from tripcast.functions.exact import exact_double_avg
from tripcast.functions.labels import business_month_label
from tripcast.functions.money import safe_ratio
from tripcast.sources.parquet import PARTITION_COLUMN


def within_bounds(column: str, lower: float | None, upper: float | None,
                  inclusive: bool = False) -> Column:
    """``lower < column < upper``; bounds are strict unless ``inclusive``,
    ``None`` leaves that side open."""
    n = F.col(column)
    cond = F.lit(True)
    if lower is not None:
        cond = cond & ((n >= lower) if inclusive else (n > lower))
    if upper is not None:
        cond = cond & ((n <= upper) if inclusive else (n < upper))
    return cond


def monthly_measures(trips: DataFrame, by_year: bool = False) -> DataFrame:
    """Per business and month: trips, platform profit and driver pay in one
    pass.  Columns: business, month, business_date ('Uber-1'), trip_count,
    total_profit, total_driver_pay.  ``by_year`` uses yyyymm instead of the
    bare month number (safe for data spanning several years)."""
    month = (year_month_of("date") if by_year else month_of("date")).cast("int")
    return (trips.groupBy("business", month.alias("month"))
            .agg(ms.trips_in(trips).alias("trip_count"),
                 ms.money_sum(trips, "rideshare_profit").alias("total_profit"),
                 ms.money_sum(trips, "driver_total_pay").alias("total_driver_pay"))
            .select("business", "month",
                    business_month_label("business", "month").alias("business_date"),
                    "trip_count", "total_profit", "total_driver_pay"))


def averages_by(trips: DataFrame, key: str = "time_of_day") -> DataFrame:
    """Per ``key``: average driver pay, average trip length and their ratio
    (average earned per mile = avg(pay) / avg(length), a ratio of averages),
    all from one aggregation instead of two aggregates joined together.  Both
    averages have exact numerators, whatever the partitioning."""
    return (trips.groupBy(key)
            .agg(ms.money_avg(trips, "driver_total_pay").alias("average_drive_total_pay"),
                 ms.double_avg(trips, "trip_length").alias("average_trip_length"))
            .withColumn("average_earning_per_mile",
                        safe_ratio(F.col("average_drive_total_pay"),
                                   F.col("average_trip_length"))))


def daily_average(trips: DataFrame, value: str = "request_to_pickup",
                  month: int | None = 1, name: str = "average_wait") -> DataFrame:
    """Average of ``value`` per day of month, restricted to one month
    (January by default).  Columns: day, ``name``, trip_count."""
    if month is not None and PARTITION_COLUMN in trips.columns:
        # Month-partitioned storage: the same month test on the partition
        # column prunes whole directories before any file is opened.
        trips = trips.filter(F.pmod(F.col(PARTITION_COLUMN), F.lit(100)) == month)
    df = trips.select(month_of("date").alias("_m"), day_of("date").cast("int").alias("day"),
                      F.col(value).alias("_v"))
    if month is not None:
        df = df.filter(F.col("_m") == month)
    return df.groupBy("day").agg(exact_double_avg("_v").alias(name),
                                 F.count(F.col("_v")).alias("trip_count"))


def above_threshold(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Rows whose ``column`` is strictly greater than ``threshold``."""
    return df.filter(F.col(column) > F.lit(threshold))
