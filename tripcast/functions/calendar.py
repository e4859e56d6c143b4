"""Calendar expressions over the trip ``date`` column (Unix seconds).

The source stores each trip's request day as the Unix timestamp of that day's
UTC midnight.  All helpers go through a DATE value built from whole days since
the epoch, so results do not depend on ``spark.sql.session.timeZone`` (a
``from_unixtime`` based formula would shift every day by the zone offset).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trip_day(c: str | Column = "date") -> Column:
    """Unix seconds -> DATE (UTC calendar day)."""
    return F.date_from_unix_date(F.floor(_c(c) / SECONDS_PER_DAY).cast("int"))


def iso_date(c: str | Column = "date") -> Column:
    """Unix seconds -> 'yyyy-MM-dd' text, e.g. 1684713600 -> '2023-05-22'."""
    return F.date_format(trip_day(c), "yyyy-MM-dd")


def month_of(c: str | Column = "date") -> Column:
    """Month number 1..12 (no year, as the source analyses do)."""
    return F.month(trip_day(c))


def year_month_of(c: str | Column = "date") -> Column:
    """Year*100 + month, for data spanning more than one year."""
    d = trip_day(c)
    return F.year(d) * 100 + F.month(d)


def month_start(year_month: str | Column) -> Column:
    """Year*100 + month -> Unix seconds of the month's first day."""
    m = _c(year_month).cast("int")
    return F.unix_date(F.make_date(F.floor(m / 100).cast("int"), F.pmod(m, F.lit(100)), F.lit(1))).cast("long") * SECONDS_PER_DAY


def day_of(c: str | Column = "date") -> Column:
    """Day of month 1..31."""
    return F.dayofmonth(trip_day(c))


def unix_day_seconds(ts: str | Column) -> Column:
    """Timestamp / timestamp_ntz / date -> Unix seconds of its day's midnight."""
    return F.unix_date(F.to_date(_c(ts))).cast("long") * SECONDS_PER_DAY


# Time-of-day classes by hour of the request.
# morning 06-11, afternoon 12-16, evening 17-19, night otherwise.
TIME_OF_DAY_BOUNDS = [("morning", 6, 11), ("afternoon", 12, 16), ("evening", 17, 19)]
TIME_OF_DAY_OTHER = "night"


def time_of_day_class(hour: str | Column) -> Column:
    """Hour 0..23 -> morning / afternoon / evening / night."""
    h = _c(hour)
    expr = None
    for label, lo, hi in TIME_OF_DAY_BOUNDS:
        cond = h.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.when(h.isNotNull(), F.lit(TIME_OF_DAY_OTHER))
