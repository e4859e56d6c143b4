"""One-pass ingest, quarantine, row-group skipping, safe sinks."""
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import SAMPLE_CSV, ZONES_CSV, trip
from tripcast.__main__ import main
from tripcast.operators.enrich import id_ranges
from tripcast.plans import catalogue as cat
from tripcast.schema import TRIP_SCHEMA
from tripcast.sources.csv import read_trips_csv, reject_counts
from tripcast.sources.ingest import ingest
from tripcast.sources.parquet import read_quarantine, read_trips_parquet, write_trips_parquet
from tripcast.sources.sinks import write_chart_csv, write_csv, write_parquet

BAD = ['Uber,x,2,abc,,1,1,1,night,1684713600,1.00,,0.5,1,1', "Uber,1,2", "Uber,1,2,1,1,1,1,1,night,1684713600,1.00,1.00,0.00,1,1,9,9",
       "Lyft,1,2,NaN,1,1,1,1,night,,3.517,1.00,0.50,Infinity,1", '"Uber, Inc",1,2,zz,1,1,1,1,night,1684713600,1.00,1.00,0.00,1,1']


def _csv(tmp_path, text, name="trips.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_one_pass_counts_like_the_report_and_keeps_every_rejected_line(spark, tmp_path):
    path, out = _csv(tmp_path, SAMPLE_CSV + "\n".join(BAD) + "\n"), str(tmp_path / "out")
    report = ingest(spark, path, out)
    assert report.rejected == {r["column"]: r["rejected"] for r in reject_counts(spark, path).collect()}
    assert report.rows == 10 and report.months == [202305, None]
    lines = {r["rejected_line"]: r["rejected_columns"] for r in read_quarantine(spark, out).collect()}
    assert set(lines) == set(BAD)
    assert lines[BAD[0]] == ["pickup_location", "trip_length"] and lines[BAD[1]] == ["*malformed*"]
    back = read_trips_parquet(spark, out).drop("year_month")
    assert sorted(map(str, back.collect())) == sorted(map(str, read_trips_csv(spark, path).collect()))
    assert "rejected_line" not in read_trips_parquet(spark, out).columns


def test_one_scan_of_the_csv(spark, tmp_path):
    rows = SAMPLE_CSV + "\n".join(BAD) + "\n"
    path, out = _csv(tmp_path, rows), str(tmp_path / "out")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ingest-once", "")
    try:
        ingest(spark, path, out)
        jobs = tracker.getJobIdsForGroup("ingest-once")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2  # the header's first line, then one job that reads, types, counts and writes


def test_spread_ingest_counts_the_same(spark, tmp_path):
    path = _csv(tmp_path, SAMPLE_CSV + "\n".join(BAD) + "\n")
    a, b = ingest(spark, path, str(tmp_path / "a")), ingest(spark, path, str(tmp_path / "b"), spread=3)
    assert a == b and read_quarantine(spark, str(tmp_path / "b")).count() == len(BAD)


def test_tables_written_without_quarantine_are_read_too(spark, tmp_path):
    out = str(tmp_path / "t")
    write_trips_parquet(spark.createDataFrame([trip()], TRIP_SCHEMA), out)
    assert read_quarantine(spark, out).count() == 0 and read_trips_parquet(spark, out).count() == 1


def test_cli_ingest_summary_quarantine_and_run(spark, tmp_path, capsys):
    text = SAMPLE_CSV.replace("Uber,102,157,", "Uber,1,2,").replace("Uber,235,244,", "Lyft,2,1,")
    t, z = _csv(tmp_path, text + BAD[0] + "\n"), _csv(tmp_path, ZONES_CSV, "zones.csv")
    out, summary, q = str(tmp_path / "pq"), str(tmp_path / "sum"), str(tmp_path / "quarantine")
    assert main(["ingest", "--trips", t, "--out", out, "--summary", summary], spark=spark) == 0
    assert "|trip_length        |1       |" in capsys.readouterr().out
    assert main(["quarantine", "--trips", out, "--out", q], spark=spark) == 0
    assert [r[0] for r in spark.read.text(q).collect()] == [BAD[0]]
    rows = []
    for source in (["--trips", out], ["--summary", summary]):
        res = str(tmp_path / f"res{len(rows)}")
        assert main(["run", "q16_zone_routes", *source, "--zones", z, "--out", res, "--format", "parquet"], spark=spark) == 0
        rows.append(sorted(map(tuple, spark.read.parquet(res).collect())))
    assert rows[0] == rows[1] and rows[0]
    assert main(["ingest", "--trips", t, "--out", out, "--summary", summary, "--mode", "append"], spark=spark) == 0
    spark.catalog.refreshByPath(summary)
    assert spark.read.parquet(summary).agg(F.sum("n_trips")).first()[0] == 12
    for wrong in (["--summary", summary], ["--trips", out, "--summary", summary], []):
        with pytest.raises(SystemExit):
            main(["run", "q17_edges", *wrong, "--zones", z], spark=spark)


def _groups(out, wanted):
    """Row groups of the table, and those whose statistics pass ``wanted``."""
    every = some = 0
    for folder, _, names in os.walk(out):
        for name in names:
            if name.endswith(".parquet"):
                meta = pq.ParquetFile(os.path.join(folder, name)).metadata
                index = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
                for g in range(meta.num_row_groups):
                    stats = {c: meta.row_group(g).column(i).statistics for c, i in index.items()}
                    every += 1
                    some += wanted({c: (s.min, s.max) for c, s in stats.items() if s is not None and s.has_min_max})
    return every, some


def test_borough_pair_and_time_of_day_skip_row_groups(spark, tmp_path):
    rng = random.Random(3)
    place = lambda: 7 if rng.random() < 0.33 else rng.randrange(1, 257)  # noqa: E731  a zone with a third of all trips
    rows = [trip(pu=place(), do=place(), tod=rng.choice(["morning", "evening", "night", "afternoon"]),
                 date=1672531200 + 86400 * rng.randrange(28)) for _ in range(40_000)]
    out = str(tmp_path / "t")
    spark.conf.set("parquet.block.size", "16384")
    old = spark.sparkContext._jsc.hadoopConfiguration()
    for k, v in (("parquet.block.size", "16384"), ("parquet.page.size.row.check.min", "100"), ("parquet.block.size.row.check.min", "100"),
                 ("parquet.block.size.row.check.max", "1000")):
        old.set(k, v)
    try:
        write_trips_parquet(spark.createDataFrame(rows, TRIP_SCHEMA), out, spread=4)
    finally:
        for k in ("parquet.block.size", "parquet.page.size.row.check.min", "parquet.block.size.row.check.min", "parquet.block.size.row.check.max"):
            old.unset(k)
        spark.conf.unset("parquet.block.size")
    zones = spark.createDataFrame([(i, f"B{i // 32}", f"Z{i}", "s") for i in range(257)], "LocationID int, Borough string, Zone string, service_zone string")
    hits = lambda lo, hi, s: s[0] <= hi and s[1] >= lo
    every, pair = _groups(out, lambda s: hits(64, 95, s["pickup_location"]) and hits(128, 159, s["dropoff_location"]))
    _, evening = _groups(out, lambda s: hits("evening", "evening", s["time_of_day"]))
    assert every >= 20 and pair <= every * 0.35 and evening <= every * 0.45
    trips = read_trips_parquet(spark, out)
    q = cat.q15_borough_pair_trips(trips, zones, ("B2", "B4"))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = q._jdf.queryExecution().explainString(mode)
    assert "GreaterThanOrEqual(pickup_location,64)" in plan and "LessThanOrEqual(dropoff_location,159)" in plan
    assert q.count() == sum(64 <= r[1] <= 95 and 128 <= r[2] <= 159 for r in rows)
    by_file = [r["count"] for r in trips.groupBy(F.input_file_name()).count().collect()]
    assert max(by_file) < 2 * min(by_file)  # the hot zone is dealt over all files


def test_id_ranges_cover_all_ids_in_few_ranges(spark):
    ids = [1, 2, 3, 10, 11, 50, 90, 91, 92]
    zones = spark.createDataFrame([(i, "A" if i in ids else "B", "z", "s") for i in range(100)],
                                  "LocationID int, Borough string, Zone string, service_zone string")
    df = spark.range(100).select(F.col("id").cast("int").alias("k"))
    for most in (64, 4, 2, 1):
        got = [r[0] for r in df.filter(id_ranges(zones, F.col("Borough") == "A", "k", most)).collect()]
        assert set(ids) <= set(got)
        assert (most < 4) or got == ids
    assert df.filter(id_ranges(zones, F.col("Borough") == "C", "k")).count() == 0


def test_sinks_refuse_what_exists_and_never_show_half_a_result(spark, tmp_path):
    df = spark.createDataFrame([("Uber-1", 3)], "k string, n long")
    broken = df.withColumn("n", F.raise_error(F.lit("no")).cast("long"))
    for write in (write_csv, write_parquet, lambda d, p, **kw: write_chart_csv(d, p, ["k"], **kw)):
        out = str(tmp_path / f"o{random.random()}")
        write(df, out)
        with pytest.raises(FileExistsError):
            write(df, out)
        with pytest.raises(Exception, match="no"):
            write(broken, out, mode="overwrite")
        before = sorted(os.listdir(out))
        assert any(f.startswith("part-") for f in before)
        write(df, out, mode="overwrite")
        with pytest.raises(Exception, match="no"):
            write(broken, out + "-new")
        assert not os.path.exists(out + "-new")
        with pytest.raises(ValueError):
            write(df, out, mode="append")
    assert not [f for f in os.listdir(tmp_path) if f.startswith(".")]
