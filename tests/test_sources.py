import os
import tempfile

import pytest

from tests.conftest import SAMPLE_CSV, ZONES_CSV
from tripcast.schema import TRIP_COLUMNS, ZONE_COLUMNS
from tripcast.sources.csv import read_trips_csv, read_zones_csv, reject_counts
from tripcast.sources.parquet import read_trips_parquet, write_trips_parquet
from tripcast.sources.sinks import write_csv


def _write(text):
    d = tempfile.mkdtemp(prefix="tripcast-csv-")
    p = os.path.join(d, "data.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_read_trips_typed(spark):
    df = read_trips_csv(spark, _write(SAMPLE_CSV))
    assert df.columns == TRIP_COLUMNS
    rows = df.collect()
    assert len(rows) == 5
    assert rows[0].pickup_location == 102
    assert rows[0].date == 1684713600
    assert str(rows[1].rideshare_profit) == "-0.18"
    assert rows[0].trip_length == 2.08


def test_bad_numbers_become_null_and_are_counted(spark):
    bad = SAMPLE_CSV + "Lyft,x,2,abc,,1,1,1,night,1684713600,1.00,,0.5,1,1\n"
    p = _write(bad)
    df = read_trips_csv(spark, p)
    last = [r for r in df.collect() if r.business == "Lyft"][0]
    assert last.pickup_location is None and last.trip_length is None
    assert last.request_to_pickup is None and last.driver_total_pay is None
    rej = {r.column: r.rejected for r in reject_counts(spark, p).collect()}
    assert rej["pickup_location"] == 1
    assert rej["trip_length"] == 1
    assert rej["request_to_pickup"] == 0   # empty is missing, not rejected
    assert rej["driver_total_pay"] == 0
    assert rej["date"] == 0
    assert rej["*any*"] == 1   # one record holds both rejected fields


def test_zone_names_na_kept_as_text(spark):
    z = read_zones_csv(spark, _write(ZONES_CSV))
    assert z.columns == ZONE_COLUMNS
    rows = {r.LocationID: r for r in z.collect()}
    assert rows[264].Zone == "NV" and rows[264].service_zone == "N/A"
    assert rows[265].Zone == "NA" and rows[265].service_zone is None
    assert rows[265].Borough == "Unknown"


def test_missing_column_fails_and_order_is_free(spark):
    with pytest.raises(ValueError, match="pickup_location"):
        read_trips_csv(spark, _write(SAMPLE_CSV.replace("pickup_location", "pickup_loc", 1)))
    lines = [line.split(",") for line in SAMPLE_CSV.strip().split("\n")]
    turned = "\n".join(",".join(reversed([*line, "extra"])) for line in lines) + "\n"
    a = read_trips_csv(spark, _write(SAMPLE_CSV)).collect()
    b = read_trips_csv(spark, _write(turned)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_inexact_and_non_finite_values_are_rejected(spark):
    rows = ["Uber,1,2,NaN,1,1,1,1,night,1684713600,3.517,1.00,0.50,Infinity,1",
            "Uber,1,2,3.517,1,1,1,1,night,1684713600,3.500,12345678901.00,0.5,1,1"]
    p = _write(SAMPLE_CSV.split("\n")[0] + "\n" + "\n".join(rows) + "\n")
    a, b = read_trips_csv(spark, p).collect()
    assert a.trip_length is None and a.passenger_fare is None and a.hourly_rate is None
    assert b.trip_length == 3.517 and str(b.passenger_fare) == "3.50" and b.driver_total_pay is None
    rej = {r.column: r.rejected for r in reject_counts(spark, p).collect()}
    assert rej["trip_length"] == rej["passenger_fare"] == rej["hourly_rate"] == rej["driver_total_pay"] == 1
    assert rej["*malformed*"] == 0 and rej["*any*"] == 2


def test_short_and_long_lines_are_counted(spark):
    p = _write(SAMPLE_CSV + "Uber,1,2\n" + "Uber,1,2,1,1,1,1,1,night,1684713600,1.00,1.00,0.00,1,1,9,9\n")
    assert read_trips_csv(spark, p).count() == 7   # kept as rows
    rej = {r.column: r.rejected for r in reject_counts(spark, p).collect()}
    assert rej["*malformed*"] == 2 and rej["*any*"] == 2


def test_parquet_roundtrip_partitioned(spark):
    df = read_trips_csv(spark, _write(SAMPLE_CSV))
    out = os.path.join(tempfile.mkdtemp(prefix="tripcast-pq-"), "trips")
    write_trips_parquet(df, out)
    back = read_trips_parquet(spark, out)
    assert back.count() == 5
    assert [d for d in os.listdir(out) if d.startswith("year_month=")] == ["year_month=202305"]
    assert back.filter("year_month = 202305").count() == 5


def test_csv_sink_single_file(spark):
    df = spark.createDataFrame([("Uber-1", 3)], "k string, n long")
    out = os.path.join(tempfile.mkdtemp(prefix="tripcast-sink-"), "o")
    write_csv(df, out, single_file=True)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1
    write_csv(df, out, single_file=True, mode="overwrite")


def test_chart_csv_in_order(spark):
    from tripcast.sources.sinks import write_chart_csv
    df = spark.createDataFrame([("Uber", 10), ("Lyft", 2), ("Uber", 2), ("Uber", 1)],
                               "business string, month int").repartition(3)
    out = os.path.join(tempfile.mkdtemp(prefix="tripcast-chart-"), "o")
    write_chart_csv(df, out, ["business", "month"])
    back = spark.read.option("header", True).csv(out).collect()
    assert [(r.business, int(r.month)) for r in back] == \
        [("Lyft", 2), ("Uber", 1), ("Uber", 2), ("Uber", 10)]


def test_january_query_prunes_month_partitions(spark):
    from tests.conftest import trip
    from tripcast.operators.aggregate import daily_average
    from tripcast.schema import TRIP_SCHEMA
    rows = [trip(date=1672531200, wait=100.0), trip(date=1672617600, wait=200.0),
            trip(date=1684713600, wait=999.0), trip(date=1704067200, wait=50.0)]
    out = os.path.join(tempfile.mkdtemp(prefix="tripcast-prune-"), "trips")
    write_trips_parquet(spark.createDataFrame(rows, TRIP_SCHEMA), out)
    q = daily_average(read_trips_parquet(spark, out))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    got = {r.day: r.average_wait for r in q.collect()}
    assert got == {1: 75.0, 2: 200.0}   # Jan 2023 and Jan 2024 share the month


def test_parquet_write_with_spread(spark):
    from tests.conftest import trip
    from tripcast.schema import TRIP_SCHEMA
    rows = [trip(pu=1, date=1672531200 + 86400 * (i % 40)) for i in range(50)]
    out = os.path.join(tempfile.mkdtemp(prefix="tripcast-spread-"), "trips")
    write_trips_parquet(spark.createDataFrame(rows, TRIP_SCHEMA), out, spread=4)
    back = read_trips_parquet(spark, out)
    assert back.count() == 50
    assert {r.year_month for r in back.select("year_month").distinct().collect()} == \
        {202301, 202302}


def test_per_business_chart_files(spark, make_trips):
    from tests.conftest import trip
    from tripcast.operators.aggregate import monthly_measures
    from tripcast.sources.sinks import write_per_business_csv
    t = make_trips([trip(date=1672531200), trip(date=1696118400), trip(business="Lyft")])
    out = os.path.join(tempfile.mkdtemp(prefix="tripcast-perbiz-"), "o")
    write_per_business_csv(monthly_measures(t), out, "trip_count")
    assert sorted(d for d in os.listdir(out) if d.startswith("business=")) == \
        ["business=Lyft", "business=Uber"]
    uber = spark.read.option("header", True).csv(os.path.join(out, "business=Uber")).collect()
    assert [(r.business_date, r.trip_count) for r in uber] == [("Uber-1", "1"), ("Uber-10", "1")]


def test_write_modes(spark):
    from tests.conftest import trip
    from tripcast.schema import TRIP_SCHEMA

    def month(day, n):
        return spark.createDataFrame([trip(date=day)] * n, TRIP_SCHEMA)

    out = os.path.join(tempfile.mkdtemp(prefix="tripcast-modes-"), "trips")
    write_trips_parquet(month(1675209600, 2), out)           # February
    with pytest.raises(Exception, match="already exists"):
        write_trips_parquet(month(1672531200, 3), out)
    write_trips_parquet(month(1672531200, 3), out, "append")  # then January

    def counts():
        return {r.year_month: r["count"] for r in read_trips_parquet(spark, out).groupBy("year_month").count().collect()}

    assert counts() == {202302: 2, 202301: 3}
    write_trips_parquet(month(1672531200, 4), out, "replace-months")
    spark.catalog.refreshByPath(out)
    assert counts() == {202302: 2, 202301: 4}
    with pytest.raises(ValueError, match="mode must be"):
        write_trips_parquet(month(1672531200, 4), out, "upsert")


def test_queries_build_without_jobs_over_trips(spark):
    """Registered queries are lazy plans over the given tables."""
    import __spark_entry__ as ent
    plan = ent.queries()["q02_trips_per_business_month"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" in plan and "tripcast" not in plan
    assert "l_extendedprice" not in plan   # only the columns the query needs
