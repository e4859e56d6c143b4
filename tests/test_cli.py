import os
import tempfile

from tests.conftest import SAMPLE_CSV, ZONES_CSV
from tripcast.__main__ import QUERY_NAMES, main


def _files():
    d = tempfile.mkdtemp(prefix="tripcast-cli-")
    t, z = os.path.join(d, "trips.csv"), os.path.join(d, "zones.csv")
    rows = SAMPLE_CSV.strip().split("\n")
    # point two sample trips at zones of the lookup excerpt
    rows[1] = rows[1].replace("Uber,102,157,", "Uber,1,2,")
    rows[2] = rows[2].replace("Uber,235,244,", "Lyft,2,1,")
    with open(t, "w") as f:
        f.write("\n".join(rows) + "\n")
    with open(z, "w") as f:
        f.write(ZONES_CSV)
    return d, t, z


def test_cli_ingest_and_run(spark):
    d, t, z = _files()
    pq = os.path.join(d, "trips_pq")
    assert main(["ingest", "--trips", t, "--out", pq], spark=spark) == 0
    assert main(["ingest", "--trips", t, "--out", pq, "--mode", "replace-months"], spark=spark) == 0
    assert spark.read.parquet(pq).count() == 5
    out = os.path.join(d, "q16")
    assert main(["run", "q16_top_zone_routes", "--trips", pq, "--zones", z, "--out", out],
                spark=spark) == 0
    got = spark.read.option("header", True).csv(out).collect()
    assert sorted((r.Route, r.uber_count, r.lyft_count) for r in got) == [
        ("Jamaica Bay to Newark Airport", "0", "1"), ("Newark Airport to Jamaica Bay", "1", "0")]
    out2 = os.path.join(d, "q02")
    assert main(["run", "q02_trips_per_business_month", "--trips", t, "--zones", z,
                 "--out", out2, "--format", "parquet"], spark=spark) == 0
    assert spark.read.parquet(out2).count() == 2
    assert "q20_pagerank_top5" in QUERY_NAMES


def test_cli_rejects(spark, capsys):
    d, t, z = _files()
    with open(t, "a") as f:
        f.write("Uber,x,2,1.0,,1,1,1,night,1684713600,1.00,1.00,0.00,1,1\n")
    assert main(["rejects", "--trips", t], spark=spark) == 0
    out = capsys.readouterr().out
    assert "pickup_location" in out and "|1       |" in out


def test_cli_parameters(spark):
    d, t, z = _files()
    out = os.path.join(d, "pair")
    assert main(["run", "q15_borough_pair_count", "--trips", t, "--zones", z, "--out", out,
                 "--param", "pair=EWR,Queens"], spark=spark) == 0
    assert spark.read.option("header", True).csv(out).first().trip_count == "1"
    out2 = os.path.join(d, "top1")
    assert main(["run", "q05_top_pickup_boroughs", "--trips", t, "--zones", z, "--out", out2,
                 "--param", "k=1"], spark=spark) == 0
    rows = spark.read.option("header", True).csv(out2).collect()
    assert len(rows) == 1 and rows[0].Pickup_Borough in ("EWR", "Queens")


def test_cli_charts_and_samples(spark):
    d, t, z = _files()
    folder = os.path.join(d, "csv_folder")   # a folder of CSV files, whatever its name
    os.makedirs(folder)
    os.rename(t, os.path.join(folder, "part-0"))
    base = ["--trips", folder, "--zones", z]
    out = os.path.join(d, "chart")
    assert main(["run", "q03_profit_per_business_month", *base, "--out", out, "--format", "per-business"], spark=spark) == 0
    assert sorted(x for x in os.listdir(out) if x.startswith("business=")) == ["business=Lyft", "business=Uber"]
    out = os.path.join(d, "chart2")
    assert main(["run", "q02_trips_per_business_month", *base, "--out", out, "--format", "chart"], spark=spark) == 0
    assert [r.business_date for r in spark.read.option("header", True).csv(out).collect()] == ["Lyft-5", "Uber-5"]
    for name in ("q01_enriched_sample", "q17_edges_sample", "q17_vertices_sample", "q18_triplets_sample", "q19_pairs_sample",
                 "q18_triplets_nested", "q20_pagerank", "q16_zone_routes", "q02_04_monthly_summary_by_year", "q21_time_of_day_rule"):
        out = os.path.join(d, name)
        assert main(["run", name, *base, "--out", out, "--format", "parquet"], spark=spark) == 0
        rows = [tuple(r) for r in spark.read.parquet(out).collect()]
        assert len(rows) == len(set(map(str, rows))), name
