"""Result sinks.

A result is written to a hidden folder beside its path and renamed when it is
complete, so a job that fails leaves nothing half written.  A path that exists is
refused (``mode="errorifexists"``) or, with ``mode="overwrite"``, kept until the
new result is whole.

Results of the catalogue are aggregates with at most a few hundred thousand
rows; ``single_file=True`` folds them into one part file (the chart-ready CSV
the analysts download).  Never use it on a fact-sized DataFrame: it funnels
every row through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripcast.sources.files import write_whole

SINK_MODES = ("errorifexists", "overwrite")


def _whole(df: DataFrame, path: str, mode: str, write) -> None:
    if mode not in SINK_MODES:
        raise ValueError(f"mode must be one of {', '.join(SINK_MODES)}, got {mode}")
    write_whole(df.sparkSession, path, write, overwrite=mode == "overwrite")


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "errorifexists") -> None:
    out = df.coalesce(1) if single_file else df
    _whole(df, path, mode, lambda p: out.write.option("header", True).csv(p))


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.partitionBy(*partition_by) if partition_by else df.write
    _whole(df, path, mode, lambda p: w.parquet(p))


def write_chart_csv(df: DataFrame, path: str, order_by: list[str], mode: str = "errorifexists") -> None:
    """One header CSV in chart order (e.g. business, month) for a small
    aggregate: everything is folded into one partition first, so a sort
    within that partition is a total order without a range-partitioning
    pass."""
    out = df.coalesce(1).sortWithinPartitions(*order_by)
    _whole(df, path, mode, lambda p: out.write.option("header", True).csv(p))


def write_per_business_csv(monthly: DataFrame, path: str, measure: str, mode: str = "errorifexists") -> None:
    """Chart files of a per-business-month result: one header CSV per
    business (``business=<name>/part-*.csv``) with the ``business_date``
    label and one measure, in month order.  For small aggregates only."""
    out = (monthly.select("business", "month", "business_date", measure)
           .coalesce(1).sortWithinPartitions("business", "month").drop("month"))
    _whole(monthly, path, mode, lambda p: out.write.option("header", True).partitionBy("business").csv(p))
