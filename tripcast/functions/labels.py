"""Text labels used as grouping keys (routes, business-month)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Route separator and the name used for a missing zone name.
ROUTE_SEPARATOR = " to "
UNKNOWN_NAME = "Unknown"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def route_label(origin: str | Column, destination: str | Column) -> Column:
    """'A to B'.  A NULL name becomes 'Unknown' so that a missing name never
    collapses a route into a bare 'B' (concat_ws would silently skip it)."""
    return F.concat_ws(ROUTE_SEPARATOR,
                       F.coalesce(_c(origin), F.lit(UNKNOWN_NAME)),
                       F.coalesce(_c(destination), F.lit(UNKNOWN_NAME)))


def business_month_label(business: str | Column, month: str | Column) -> Column:
    """'Uber-1' style label for charts."""
    return F.concat_ws("-", _c(business), _c(month).cast("string"))
