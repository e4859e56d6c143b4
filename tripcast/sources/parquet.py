"""Parquet storage of the typed trip table.

At scale the CSV is typed once and kept as Parquet partitioned by month of
the request day, so month filters prune whole directories and every query
reads only the columns it projects.  Within a file a month's rows are sorted by
time of day and then along a space-filling curve over pickup, dropoff and day:
a row group holds few times of day and a small patch of zone pairs, so filters on
those skip most row groups by their statistics.  The order is made inside each task,
which needs no shuffle and no range sampling, and a zone that holds a third
of all trips stays dealt over all tasks.

A line of the CSV that lost something on the way in is kept whole in the columns
QUARANTINE of its row (``tripcast.sources.ingest``), which ordinary readers do
not select.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast.functions.calendar import day_of, year_month_of
from tripcast.functions.zorder import interleaved
from tripcast.schema import TRIP_COLUMNS, TRIP_SCHEMA, ZONE_COLUMNS

PARTITION_COLUMN = "year_month"
QUARANTINE = ["rejected_line", "rejected_columns"]
STORED_SCHEMA = T.StructType([*TRIP_SCHEMA.fields, T.StructField("rejected_line", T.StringType()),
                              T.StructField("rejected_columns", T.ArrayType(T.StringType())),
                              T.StructField(PARTITION_COLUMN, T.IntegerType())])

MODES = ("errorifexists", "append", "replace-months", "overwrite")


def laid_out(trips: DataFrame, spread: int | None = None) -> DataFrame:
    """Trips with their month, as they are stored: optionally re-balanced, sorted
    within each task."""
    kept = [c for c in (*TRIP_COLUMNS, *QUARANTINE) if c in trips.columns]
    out = trips.select(*kept).withColumn(PARTITION_COLUMN, year_month_of("date").cast("int"))
    if spread:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in TRIP_COLUMNS]), F.lit(spread))
        out = out.repartition(spread, F.col(PARTITION_COLUMN), salt)
    curve = interleaved(F.col("pickup_location"), F.col("dropoff_location"), day_of("date"))
    return out.sortWithinPartitions(PARTITION_COLUMN, "time_of_day", curve)


def write_trips_parquet(trips: DataFrame, path: str, mode: str = "errorifexists",
                        spread: int | None = None) -> None:
    """Write the typed trip table partitioned by ``year_month``.

    ``mode``: ``errorifexists`` refuses an existing table, ``append`` adds
    files, ``replace-months`` replaces the months that ``trips`` holds and
    leaves the others alone (so loading a month again is safe), ``overwrite``
    replaces the whole table.

    By default there is no shuffle: each task sorts its rows by month and
    writes one file per month it holds.  ``spread=N`` re-balances into N
    tasks first (e.g. to compact many small input splits): rows are routed by
    (month, hash of the whole row mod N), so neither a month nor a zone that
    holds a third of all trips can pile up in one task, and a retried task
    receives exactly the same rows.
    """
    write_laid_out(laid_out(trips, spread), path, mode)


def write_laid_out(out: DataFrame, path: str, mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, got {mode}")
    writer = out.write.partitionBy(PARTITION_COLUMN)
    if mode == "replace-months":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode(mode).option("partitionOverwriteMode", "static").parquet(path)


def read_trips_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Typed trip table (partition column kept for pruning)."""
    return spark.read.schema(STORED_SCHEMA).parquet(path).drop(*QUARANTINE)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The lines that lost something on the way into the table at ``path``:
    year_month, rejected_line, and the columns (or ``*malformed*``) it is for."""
    return (spark.read.schema(STORED_SCHEMA).parquet(path).filter(F.col("rejected_line").isNotNull())
            .select(PARTITION_COLUMN, *QUARANTINE))


def read_zones_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*ZONE_COLUMNS)
