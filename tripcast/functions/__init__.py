"""Column expressions: calendar, money, labels."""

from tripcast.functions.calendar import (day_of, iso_date, month_of, time_of_day_class,
                                         trip_day, unix_day_seconds, year_month_of)
from tripcast.functions.labels import business_month_label, route_label
from tripcast.functions.money import exact_avg, exact_sum, safe_ratio

__all__ = [
    "day_of", "iso_date", "month_of", "time_of_day_class", "trip_day",
    "unix_day_seconds", "year_month_of", "business_month_label", "route_label",
    "exact_avg", "exact_sum", "safe_ratio",
]
