"""Per-category counts side by side (e.g. Uber and Lyft trips per route).

One aggregation with one conditional count per category replaces
"filter per category, group each, full outer join, add": one scan, one
shuffle of partial counts, and a category that never used a key gets 0
instead of NULL (the outer-join form also loses the key of one-sided rows).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcast.functions.measures import trips_where


def side_by_side_counts(df: DataFrame, keys: Iterable[str | Column], category: str,
                        columns: Mapping[str, str],
                        total: str = "total_count") -> DataFrame:
    """``columns`` maps category value -> output column name.  ``total``
    counts only the listed categories."""
    cat = F.col(category)
    aggs = [trips_where(df, cat == F.lit(v)).alias(name) for v, name in columns.items()]
    out = df.groupBy(*keys).agg(*aggs)
    tot = None
    for name in columns.values():
        tot = F.col(name) if tot is None else tot + F.col(name)
    return out.withColumn(total, tot).filter(F.col(total) > 0)
