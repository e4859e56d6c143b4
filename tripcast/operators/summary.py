"""A stored trip summary that most of the catalogue can read instead of trips.

One row per month, business, pickup, dropoff and time of day: number of trips,
exact sums of money, exact partial sums of doubles and counts of values.  Rows
of two summaries of different trips add up, so the summary of a month is worked
out from that month alone: :func:`refresh` replaces the months that a load
touched and reads nothing else.  Its size is bounded by the number of zone
pairs, businesses and times of day in a month, however many trips there are
(265 x 265 x 2 x 4 rows at most for the real lookup).

Every query that counts, sums or averages over these columns takes a summary
in the place of trips and gives the same rows (``tripcast.functions.measures``).
Queries about single trips, waiting times or metrics that are not kept (Q01
rows, Q11, Q12, Q15 rows, Q17 edges, Q21, Q22) need the trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.functions import measures as ms
from tripcast.functions.calendar import month_start, year_month_of
from tripcast.sources.files import drop_folder
from tripcast.sources.parquet import PARTITION_COLUMN

KEYS = ["business", "pickup_location", "dropoff_location", "time_of_day"]


def summarise(trips: DataFrame) -> DataFrame:
    """Trips, or a summary to be folded further, to one row per month and key.
    One partial aggregate and one shuffle of at most one row per group and task."""
    return trips.withColumn(PARTITION_COLUMN, _month(trips)).groupBy(PARTITION_COLUMN, *KEYS).agg(*ms.partials(trips))


def _month(trips: DataFrame):
    return F.col(PARTITION_COLUMN) if PARTITION_COLUMN in trips.columns else year_month_of("date").cast("int")


def refresh(trips: DataFrame, path: str, months: list[int | None] | None = None) -> None:
    """Write the summary of ``trips`` to ``path``, by month.  ``months``: only these
    are worked out and replaced, and only their trips are read where trips are
    stored by month; the files of other months stay as they are.  A month that has
    no trips any more loses its rows.  None stands for trips without a date."""
    rows = trips
    if months is not None:
        known = [int(m) for m in months if m is not None]
        wanted = _month(trips).isin(known)
        rows = trips.filter(wanted | _month(trips).isNull() if None in months else wanted)
    out = summarise(rows).repartition(PARTITION_COLUMN).sortWithinPartitions(PARTITION_COLUMN, "pickup_location", "dropoff_location")
    writer = out.write.mode("overwrite").partitionBy(PARTITION_COLUMN)
    if months is None:
        writer.option("partitionOverwriteMode", "static").parquet(path)
        return
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    left = {r[0] for r in rows.select(_month(trips)).distinct().collect()}  # at most the months named
    for m in set(months) - left:
        drop_folder(trips.sparkSession, f"{path.rstrip('/')}/{PARTITION_COLUMN}={'__HIVE_DEFAULT_PARTITION__' if m is None else int(m)}")


def with_date(summary: DataFrame) -> DataFrame:
    """A summary with a ``date``, the first day of its month, as the catalogue takes it."""
    return summary.withColumn("date", month_start(PARTITION_COLUMN))


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """A stored summary, ready for the catalogue."""
    return with_date(spark.read.parquet(path))
