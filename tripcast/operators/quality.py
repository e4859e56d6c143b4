"""Data-quality reports over the trip table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.functions.money import safe_ratio

# Tolerance for the two-decimal derived rates.
RATE_TOLERANCE = 0.005000001


def derived_metric_check(trips: DataFrame) -> DataFrame:
    """One row comparing stored derived metrics with their documented
    formulas:

    * rideshare_profit = passenger_fare - driver_total_pay (exact, decimals)
    * dollars_per_mile = driver_total_pay / trip_length (two decimals)
    * hourly_rate = driver_total_pay / (on_scene_to_dropoff / 3600) (two decimals)

    ``*_checked`` counts rows where all inputs are present, ``*_mismatch``
    the checked rows that break the rule.
    """
    pay = F.col("driver_total_pay")
    profit_ok = F.col("passenger_fare") - pay == F.col("rideshare_profit")
    per_mile = safe_ratio(pay.cast("double"), F.col("trip_length"))
    per_hour = safe_ratio(pay.cast("double"), F.col("on_scene_to_dropoff") / F.lit(3600.0))
    per_mile_ok = F.abs(F.col("dollars_per_mile") - per_mile) <= RATE_TOLERANCE
    per_hour_ok = F.abs(F.col("hourly_rate") - per_hour) <= RATE_TOLERANCE
    return trips.agg(
        F.count(F.lit(1)).alias("trips"),
        F.count(profit_ok).alias("profit_checked"),
        F.count_if(~profit_ok).alias("profit_mismatch"),
        F.count(per_mile_ok).alias("per_mile_checked"),
        F.count_if(~per_mile_ok).alias("per_mile_mismatch"),
        F.count(per_hour_ok).alias("hourly_checked"),
        F.count_if(~per_hour_ok).alias("hourly_mismatch"),
    )
