"""Command line: run the catalogue over real trip data.

    spark-submit --py-files tripcast.zip tripcast/__main__.py ingest \
        --trips <trip csv> --out <parquet dir> \
        [--mode errorifexists|append|replace-months|overwrite] [--summary <parquet dir>]
    spark-submit --py-files tripcast.zip tripcast/__main__.py rejects --trips <trip csv>
    spark-submit --py-files tripcast.zip tripcast/__main__.py quarantine --trips <parquet dir> --out <dir>
    spark-submit --py-files tripcast.zip tripcast/__main__.py run q05_top_pickup_boroughs \
        --trips <csv or parquet> --zones <zone csv> [--trips-format csv|parquet]
        [--summary <parquet dir>] [--out <dir>] [--mode errorifexists|overwrite]
        [--format csv|parquet|chart|per-business] [--single-file] [--show N]

(or ``python -m tripcast ...`` locally).  ``--trips`` may be the raw CSV
(typed on the fly) or the Parquet table written by ``ingest``; which of them it
is, is seen from the files unless ``--trips-format`` says so.  Queries use the
source analyses' default parameters.  ``ingest`` scans the CSV once, prints the
reject counts, keeps rejected lines for ``quarantine`` and, with ``--summary``,
brings the trip summary up to date for the months it loaded; ``run --summary``
answers from the summary (queries over single trips need ``--trips``).
Results are written by all tasks and appear under their name when complete; ``--single-file`` and the chart formats fold
a small aggregate into one file (per business).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.plans import catalogue as cat
from tripcast.sources.parquet import MODES


# Query name -> (catalogue function, inputs it takes: t = trips, z = zones).
CATALOGUE = {
    "q01_enriched": (cat.q01_enriched, "tz"),
    "q01_row_count": (cat.q01_row_count, "tz"),
    "q01_enriched_sample": (cat.q01_enriched_sample, "tz"),
    "q02_trips_per_business_month": (cat.q02_trips_per_business_month, "t"),
    "q03_profit_per_business_month": (cat.q03_profit_per_business_month, "t"),
    "q04_driver_pay_per_business_month": (cat.q04_driver_pay_per_business_month, "t"),
    "q02_04_monthly_summary": (cat.monthly_summary, "t"),
    "q02_04_monthly_summary_by_year": (lambda t: cat.monthly_summary(t, by_year=True), "t"),
    "q05_top_pickup_boroughs": (cat.q05_top_pickup_boroughs, "tz"),
    "q06_top_dropoff_boroughs": (cat.q06_top_dropoff_boroughs, "tz"),
    "q07_top_routes_by_pay": (cat.q07_top_routes_by_pay, "tz"),
    "q08_avg_pay_by_time_of_day": (cat.q08_avg_pay_by_time_of_day, "t"),
    "q09_avg_length_by_time_of_day": (cat.q09_avg_length_by_time_of_day, "t"),
    "q10_earning_per_mile": (cat.q10_earning_per_mile, "t"),
    "q10_avg_dollars_per_mile": (cat.q10_avg_dollars_per_mile, "t"),
    "q11_january_daily_wait": (cat.q11_daily_wait, "t"),
    "q12_wait_anomaly_days": (cat.q12_wait_anomaly_days, "t"),
    "q13_low_volume_pickups": (cat.q13_low_volume_pickups, "tz"),
    "q13_below_average_pickups": (cat.q13_below_average_pickups, "tz"),
    "q14_evening_pickups": (cat.q14_pickups_at_time_of_day, "tz"),
    "q15_borough_pair_trips": (cat.q15_borough_pair_trips, "tz"),
    "q15_borough_pair_sample": (cat.q15_borough_pair_sample, "tz"),
    "q15_borough_pair_count": (cat.q15_borough_pair_count, "tz"),
    "q16_top_zone_routes": (cat.q16_top_zone_routes, "tz"),
    "q16_top_routes_bounded": (cat.q16_top_routes_bounded, "tz"),
    "q16_zone_routes": (cat.zone_routes_by_business, "tz"),
    "q17_vertices": (cat.q17_vertices, "z"),
    "q17_vertices_sample": (cat.q17_vertices_sample, "z"),
    "q17_edges": (cat.q17_edges, "t"),
    "q17_edges_sample": (cat.q17_edges_sample, "t"),
    "q17_edge_weights": (cat.q17_edge_weights, "t"),
    "q17_dangling_edges": (cat.q17_dangling_edges, "tz"),
    "q18_triplets": (cat.q18_triplets, "tz"),
    "q18_triplets_nested": (cat.q18_triplets_nested, "tz"),
    "q18_triplets_sample": (cat.q18_triplets_sample, "tz"),
    "q19_same_borough_service_zone_pairs": (cat.q19_same_borough_service_zone_pairs, "tz"),
    "q19_pair_count": (cat.q19_pair_count, "tz"),
    "q19_pairs_sample": (cat.q19_pairs_sample, "tz"),
    "q20_pagerank": (cat.q20_pagerank, "tz"),
    "q20_pagerank_top5": (cat.q20_pagerank_top, "tz"),
    "q21_time_of_day_rule": (lambda t: cat.q21_time_of_day_rule(t.select(F.hour(F.timestamp_seconds("date")).alias("hour"))), "t"),
    "q22_derived_metric_check": (cat.q22_derived_metric_check, "t"),
}
QUERY_NAMES = list(CATALOGUE)
# Queries about single trips or columns that a trip summary does not keep.
TRIPS_ONLY = {"q01_enriched", "q01_enriched_sample", "q11_january_daily_wait", "q12_wait_anomaly_days", "q15_borough_pair_trips",
              "q15_borough_pair_sample", "q16_top_routes_bounded", "q17_edges", "q21_time_of_day_rule", "q22_derived_metric_check"}
# Charts of a per-business-month result: query -> measure.
CHARTS = {"q02_trips_per_business_month": "trip_count", "q03_profit_per_business_month": "total_profit",
          "q04_driver_pay_per_business_month": "total_driver_pay"}


def _value(text: str):
    """'10' -> 10, '0.5' -> 0.5, 'true' -> True, 'a,b' -> ('a', 'b'), else text."""
    if "," in text:
        return tuple(_value(t) for t in text.split(","))
    if text.lower() in ("true", "false"):
        return text.lower() == "true"
    for cast in (int, float):
        try:
            return cast(text)
        except ValueError:
            pass
    return text


def build_query(name: str, trips: DataFrame, zones: DataFrame, params: dict) -> DataFrame:
    fn, needs = CATALOGUE[name]
    args = [x for x, flag in ((trips, "t"), (zones, "z")) if flag in needs]
    return fn(*args, **params)


def _load_trips(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    from tripcast.sources.csv import read_trips_csv
    from tripcast.sources.parquet import read_trips_parquet
    if kind is None:
        kind = "parquet" if _is_parquet(spark, path) else "csv"
    return read_trips_csv(spark, path) if kind == "csv" else read_trips_parquet(spark, path)


def _is_parquet(spark: SparkSession, path: str) -> bool:
    """Whether the first data file below ``path`` starts like Parquet."""
    files = spark.read.format("text").option("recursiveFileLookup", "true").load(path).inputFiles()
    if not files:
        raise FileNotFoundError(f"no data files below {path}")
    jvm = spark.sparkContext._jvm
    first = jvm.org.apache.hadoop.fs.Path(sorted(files)[0])
    stream = first.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(first)
    try:
        return bytes(stream.read() & 255 for _ in range(4)) == b"PAR1"
    finally:
        stream.close()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tripcast")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest", help="type the trip CSV once into month-partitioned Parquet")
    ing.add_argument("--trips", required=True)
    ing.add_argument("--out", required=True)
    ing.add_argument("--mode", choices=MODES, default="errorifexists")
    ing.add_argument("--spread", type=int, help="re-balance into this many tasks before writing")
    ing.add_argument("--summary", help="trip summary to bring up to date for the months loaded")
    rej = sub.add_parser("rejects", help="per column: non-empty values that fail to type")
    rej.add_argument("--trips", required=True)
    qua = sub.add_parser("quarantine", help="the rejected lines of an ingested table, as text")
    qua.add_argument("--trips", required=True)
    qua.add_argument("--out", required=True)
    run = sub.add_parser("run", help="run one catalogue query")
    run.add_argument("query", choices=QUERY_NAMES)
    run.add_argument("--trips")
    run.add_argument("--summary", help="trip summary to read instead of trips")
    run.add_argument("--zones", required=True)
    run.add_argument("--out")
    run.add_argument("--mode", choices=["errorifexists", "overwrite"], default="errorifexists", help="if --out exists")
    run.add_argument("--trips-format", choices=["csv", "parquet"])
    run.add_argument("--format", choices=["csv", "parquet", "chart", "per-business"], default="csv")
    run.add_argument("--single-file", action="store_true", help="fold a small CSV result into one file")
    run.add_argument("--show", type=int, default=0)
    run.add_argument("--param", action="append", default=[], metavar="KEY=VALUE",
                     help="query parameter, e.g. k=10, threshold=250, "
                          "pair=Brooklyn,Staten Island, bounds=0,1000, time_of_day=night")
    args = ap.parse_args(argv)

    from tripcast.session import get_session
    spark = spark or get_session()
    if args.cmd == "rejects":
        from tripcast.sources.csv import reject_counts
        reject_counts(spark, args.trips).show(50, truncate=False)
        return 0
    if args.cmd == "ingest":
        from tripcast.operators.summary import refresh
        from tripcast.sources.files import folder_exists
        from tripcast.sources.ingest import ingest
        from tripcast.sources.parquet import read_trips_parquet
        report = ingest(spark, args.trips, args.out, args.mode, args.spread)
        report.table(spark).show(50, truncate=False)
        if args.summary:
            # A new or overwritten table, or a first summary: all months; else those of this load.
            whole = args.mode in ("errorifexists", "overwrite") or not folder_exists(spark, args.summary)
            refresh(read_trips_parquet(spark, args.out), args.summary, None if whole else report.months)
        return 0
    if args.cmd == "quarantine":
        from tripcast.sources.files import write_whole
        from tripcast.sources.parquet import read_quarantine
        lines = read_quarantine(spark, args.trips).select("rejected_line")
        write_whole(spark, args.out, lambda p: lines.write.text(p))
        return 0
    if bool(args.trips) == bool(args.summary):
        ap.error("run takes either --trips or --summary")
    if args.summary and args.query in TRIPS_ONLY:
        ap.error(f"{args.query} needs --trips")

    from tripcast.sources.csv import read_zones_csv
    from tripcast.sources.sinks import write_chart_csv, write_csv, write_parquet, write_per_business_csv
    params = dict(p.split("=", 1) for p in args.param)
    if args.summary:
        from tripcast.operators.summary import read_summary
        trips = read_summary(spark, args.summary)
    else:
        trips = _load_trips(spark, args.trips, args.trips_format)
    df = build_query(args.query, trips, read_zones_csv(spark, args.zones), {k: _value(v) for k, v in params.items()})
    seen = None
    if args.query == "q01_enriched" and args.out:  # what finds no zone is counted while the rows are written
        df, seen = cat.q01_reported(trips, read_zones_csv(spark, args.zones))
    if args.out:
        if args.format in ("chart", "per-business"):
            if args.query not in CHARTS:
                ap.error(f"{args.format} files are made of {', '.join(CHARTS)}")
            if args.format == "chart":
                write_chart_csv(df, args.out, ["business", "month"], mode=args.mode)
            else:
                write_per_business_csv(df, args.out, CHARTS[args.query], mode=args.mode)
        elif args.format == "csv":
            write_csv(df, args.out, single_file=args.single_file, mode=args.mode)
        else:
            write_parquet(df, args.out, mode=args.mode)
    if seen is not None:
        from tripcast.operators.enrich import unmatched_report
        for name, value in unmatched_report(seen).items():
            print(f"{name}: {value}")
    if args.show:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
