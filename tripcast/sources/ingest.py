"""One-pass ingest of the trip CSV.

One job reads the CSV, types it, writes the month-partitioned table and counts:
the counters are observed on the rows being written, so nothing is scanned
twice.  A line that lost a value (text that does not type, see ``sources.csv``)
or has too few or too many fields stays a row of the table and is kept whole in
its ``rejected_line``, with what it was rejected for; ``read_quarantine`` gives
these lines back, reading that column only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast.schema import TRIP_FIELDS
from tripcast.sources.csv import CORRUPT, faults, read_text_table, type_columns
from tripcast.sources.parquet import PARTITION_COLUMN, laid_out, write_laid_out


@dataclass(frozen=True)
class Report:
    rows: int
    rejected: dict[str, int]  # by column, ``*malformed*`` and ``*any*``, as ``reject_counts`` has them
    months: list[int | None]  # the months that the load touched, None for trips without a date

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([*self.rejected.items()], "column string, rejected long")


def typed_with_faults(spark: SparkSession, path: str, fields=TRIP_FIELDS) -> DataFrame:
    """Typed rows with ``rejected_line`` and ``rejected_columns`` (NULL where nothing was lost)."""
    raw = read_text_table(spark, path, fields, whole_lines=True)
    bad = faults(fields)
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in bad.items()]))
    given = [c for c in raw.columns if c != CORRUPT]
    line = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*given)))
    held = raw.select("*", names.alias("_for"))
    held = held.select("*", F.when(F.size("_for") > 0, line).alias("rejected_line"),
                       F.when(F.size("_for") > 0, F.col("_for")).alias("rejected_columns"))
    return type_columns(held, [*fields, ("rejected_line", T.StringType()), ("rejected_columns", None)])


def ingest(spark: SparkSession, csv_path: str, out: str, mode: str = "errorifexists", spread: int | None = None) -> Report:
    """Type the CSV into the month-partitioned table at ``out`` (modes as for
    ``write_trips_parquet``) and report what was read and rejected, in one job."""
    names = [*faults(TRIP_FIELDS)]
    seen = Observation()
    rows = laid_out(typed_with_faults(spark, csv_path), spread)
    # Observed next to the write, after any shuffle: each row counts once, whatever is retried before.
    rows = rows.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count("rejected_line").alias("any"),
        F.collect_set(PARTITION_COLUMN).alias("months"), F.count_if(F.col(PARTITION_COLUMN).isNull()).alias("dateless"),
        *[F.count_if(F.array_contains("rejected_columns", n)).alias(f"c{i}") for i, n in enumerate(names)])
    write_laid_out(rows, out, mode)
    got = seen.get
    rejected = {n: got[f"c{i}"] for i, n in enumerate(names)} | {"*any*": got["any"]}
    return Report(got["rows"], rejected, sorted(got["months"] or []) + [None] * (got["dateless"] > 0))
