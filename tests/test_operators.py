import pytest

from tests.conftest import trip
from tripcast.operators.aggregate import above_threshold, averages_by, daily_average, monthly_measures
from tripcast.operators.broadcast import fits_broadcast
from tripcast.operators.compare import side_by_side_counts
from tripcast.operators.enrich import enrich, unmatched_counts
from tripcast.operators.quality import derived_metric_check
from tripcast.operators.topk import top_k, top_k_per_group
from tripcast.plans import catalogue as cat
from tripcast.schema import ENRICHED_COLUMNS

MAY22 = 1684713600
JAN01 = 1672531200
FEB28 = 1677542400
OCT01 = 1696118400


def test_enrich_roles_and_unmatched(make_trips, zones):
    t = make_trips([trip(pu=1, do=2), trip(pu=264, do=265), trip(pu=7, do=1),
                    trip(pu=None, do=1), trip(pu=2, do=None)])
    e = cat.q01_enriched(t, zones)
    assert e.columns == ENRICHED_COLUMNS
    rows = sorted(e.collect(), key=lambda r: r.pickup_location)
    assert len(rows) == 2
    assert (rows[0].Pickup_Zone, rows[0].Dropoff_Zone) == ("Newark Airport", "Jamaica Bay")
    assert (rows[1].Pickup_Borough, rows[1].Dropoff_Zone) == ("Unknown", "NA")
    assert rows[0].date == "2023-05-22"
    u = unmatched_counts(t, zones).first()
    assert (u.trips, u.pickup_unmatched, u.dropoff_unmatched, u.enriched_rows) == (5, 2, 1, 2)


def test_monthly_measures_signed_sums(make_trips):
    t = make_trips([trip(date=JAN01, profit="-0.18", pay="13.75"),
                    trip(date=JAN01 + 86400, profit="3.51", pay="9.10"),
                    trip(business="Lyft", date=OCT01, profit="-1.00", pay="1.00"),
                    trip(date=FEB28, profit="0.01", pay="0.01")])
    got = {(r.business, r.month): r for r in monthly_measures(t).collect()}
    assert got[("Uber", 1)].trip_count == 2
    assert got[("Uber", 1)].total_profit == 3.33
    assert got[("Uber", 1)].business_date == "Uber-1"
    assert got[("Lyft", 10)].total_profit == -1.0
    assert got[("Uber", 2)].total_driver_pay == 0.01
    by_year = {(r.business, r.month) for r in monthly_measures(t, by_year=True).collect()}
    assert ("Lyft", 202310) in by_year


def test_top_k_per_group_ties_break_on_name(spark):
    df = spark.createDataFrame(
        [("B", 1, 5), ("A", 1, 5), ("C", 1, 7), ("D", 1, 1), ("A", 2, 1)],
        "Pickup_Borough string, Month int, trip_count long")
    from pyspark.sql import functions as F
    out = top_k_per_group(df, ["Month"], [F.desc("trip_count"), F.asc("Pickup_Borough")], 2)
    assert sorted(tuple(r) for r in out.collect()) == [("A", 1, 5), ("A", 2, 1), ("C", 1, 7)]
    g = top_k(df, [F.desc("trip_count"), F.asc("Pickup_Borough")], 3)
    assert [r.Pickup_Borough for r in g.collect()] == ["C", "A", "B"]


def test_top_boroughs_per_month(make_trips, zones):
    rows = ([trip(pu=1, date=MAY22)] * 3 + [trip(pu=2, date=MAY22)] * 2
            + [trip(pu=5, date=MAY22)] * 2 + [trip(pu=4, date=JAN01)])
    out = cat.q05_top_pickup_boroughs(make_trips(rows), zones, k=2)
    got = sorted(tuple(r) for r in out.collect())
    # Queens = ids 2 and 5 merged by name (4 trips) beats EWR (3)
    assert got == [("EWR", 5, 3), ("Manhattan", 1, 1), ("Queens", 5, 4)]


def test_side_by_side_counts_zero_fill(spark):
    df = spark.createDataFrame([("r1", "Uber"), ("r1", "Lyft"), ("r2", "Uber"), ("r3", "Lyft"),
                                ("r4", "Other")], "Route string, business string")
    out = side_by_side_counts(df, ["Route"], "business",
                              {"Uber": "uber_count", "Lyft": "lyft_count"})
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("r1", 1, 1, 2), ("r2", 1, 0, 1), ("r3", 0, 1, 1)]


def test_zone_routes_one_sided_and_unknown_name(make_trips, zones):
    t = make_trips([trip(pu=1, do=2), trip(pu=1, do=2, business="Lyft"), trip(pu=2, do=1),
                    trip(pu=3, do=6, business="Lyft"), trip(pu=6, do=6), trip(pu=3, do=5)])
    z = zones
    out = {r.Route: tuple(r)[1:] for r in cat.zone_routes_by_business(t, z).collect()}
    assert out["Newark Airport to Jamaica Bay"] == (1, 1, 2)
    assert out["Jamaica Bay to Newark Airport"] == (1, 0, 1)
    # ids 5 and 6 are both named Astoria: their routes merge by name
    assert out["Allerton/Pelham Gardens to Astoria"] == (1, 1, 2)
    assert out["Astoria to Astoria"] == (1, 0, 1)
    # two routes tie at 2 trips: the tie breaks on the route name
    top = cat.q16_top_zone_routes(t, z, k=2).collect()
    assert [r.Route for r in top] == ["Allerton/Pelham Gardens to Astoria",
                                      "Newark Airport to Jamaica Bay"]


def test_averages_ratio_and_zero_length(make_trips):
    t = make_trips([trip(tod="night", pay="10.00", length=2.0),
                    trip(tod="night", pay="20.00", length=4.0),
                    trip(tod="morning", pay="5.00", length=0.0),
                    trip(tod="morning", pay=None, length=None)])
    got = {r.time_of_day: r for r in averages_by(t).collect()}
    assert got["night"].average_drive_total_pay == 15.0
    assert got["night"].average_trip_length == 3.0
    assert got["night"].average_earning_per_mile == 5.0
    assert got["morning"].average_drive_total_pay == 5.0   # NULL skipped
    assert got["morning"].average_earning_per_mile is None  # 5 / 0


def test_low_volume_bounds_are_strict(make_trips, zones):
    t = make_trips([trip(pu=1)] + [trip(pu=3)] * 9 + [trip(pu=5)] * 10)
    got = {r.Pickup_Borough: r.trip_count for r in cat.q13_low_volume_pickups(t, zones, (0, 10)).collect()}
    assert got == {"EWR": 1, "Bronx": 9}
    mean = {r.Pickup_Borough for r in cat.q13_below_average_pickups(t, zones).collect()}
    assert mean == {"EWR"}   # mean group: 6.67 trips


def test_averages_are_not_cut(make_trips):
    t = make_trips([trip(length=0.004, pay="0.01"), trip(length=0.004, pay="0.02")])
    r = averages_by(t).first()
    assert r.average_trip_length == 0.004
    assert r.average_earning_per_mile == pytest.approx(0.015 / 0.004)
    w = make_trips([trip(date=JAN01, wait=x) for x in (1.005, 1.004, 1.004)])
    assert daily_average(w).first().average_wait == pytest.approx(1.0043333333333333, abs=1e-12)


def test_daily_wait_and_threshold(make_trips):
    t = make_trips([trip(date=JAN01, wait=300.0), trip(date=JAN01, wait=300.0),
                    trip(date=JAN01 + 86400, wait=300.01), trip(date=FEB28, wait=999.0),
                    trip(date=JAN01 + 86400, wait=None)])
    d = {r.day: r for r in daily_average(t).collect()}
    assert set(d) == {1, 2}
    assert d[1].average_wait == 300.0 and d[2].average_wait == 300.01
    assert d[2].trip_count == 1
    hot = [r.day for r in above_threshold(daily_average(t), "average_wait", 300).collect()]
    assert hot == [2]


def test_derived_metric_check_on_sample(spark):
    import os
    import tempfile

    from tests.conftest import SAMPLE_CSV
    from tripcast.sources.csv import read_trips_csv
    p = os.path.join(tempfile.mkdtemp(), "s.csv")
    with open(p, "w") as f:
        f.write(SAMPLE_CSV)
    r = derived_metric_check(read_trips_csv(spark, p)).first()
    assert (r.trips, r.profit_checked, r.profit_mismatch) == (5, 5, 2)
    assert (r.per_mile_checked, r.per_mile_mismatch) == (5, 0)
    assert (r.hourly_checked, r.hourly_mismatch) == (5, 0)


def test_borough_pair_and_evening(make_trips, zones):
    t = make_trips([trip(pu=2, do=1), trip(pu=5, do=1, tod="evening"), trip(pu=1, do=2),
                    trip(pu=3, do=1, tod="evening")])
    pair = cat.q15_borough_pair_trips(t, zones, pair=("Queens", "EWR"))
    assert sorted(r.Pickup_Zone for r in pair.collect()) == ["Astoria", "Jamaica Bay"]
    assert cat.q15_borough_pair_count(t, zones, pair=("Queens", "EWR")).first().trip_count == 2
    ev = {r.Pickup_Borough: r.trip_count for r in cat.q14_pickups_at_time_of_day(t, zones).collect()}
    assert ev == {"Queens": 1, "Bronx": 1}


def test_fits_broadcast(spark):
    df = spark.range(10)
    assert fits_broadcast(df, 10) and not fits_broadcast(df, 9)   # a side without files


def test_broadcast_is_bounded_by_bytes(spark):
    wide = spark.range(100).selectExpr("id", "repeat('x', 10000) AS s")
    assert fits_broadcast(wide, 100) and not fits_broadcast(wide, 100, max_bytes=500_000)
    nested = spark.range(100).selectExpr("array_repeat(repeat('x', 100), 100) AS a")
    assert not fits_broadcast(nested, 100, max_bytes=500_000)


def test_broadcast_probe_sees_a_grown_file(spark):
    import os
    import tempfile
    path = os.path.join(tempfile.mkdtemp(prefix="tripcast-grow-"), "t")
    spark.range(1).write.parquet(path)
    assert fits_broadcast(spark.read.parquet(path), 5)
    spark.range(50).coalesce(1).write.mode("overwrite").parquet(path)
    spark.catalog.refreshByPath(path)
    assert not fits_broadcast(spark.read.parquet(path), 5)


def test_sample_rows_is_reproducible(spark):
    from tripcast.operators.topk import sample_rows
    df = spark.createDataFrame([(i % 7, f"z{i}") for i in range(100)], "a int, b string")
    first = [tuple(r) for r in sample_rows(df.repartition(5), 4).collect()]
    again = [tuple(r) for r in sample_rows(df.repartition(3), 4).collect()]
    assert first == again and len({a for a, _ in first}) > 1   # spread, not a run of one value


def test_pair_sample_takes_different_trips(make_trips, zones):
    t = make_trips([trip(pu=p, do=1, fare=f"{i}.00") for i in range(40) for p in (2, 5)])
    rows = cat.q15_borough_pair_sample(t, zones, pair=("Queens", "EWR"), n=10).collect()
    assert len(rows) == 10 and {r.Pickup_Zone for r in rows} == {"Jamaica Bay", "Astoria"}


def test_enrich_falls_back_to_shuffle_join_beyond_bound(make_trips, zones):
    t = make_trips([trip(pu=1, do=2), trip(pu=264, do=265), trip(pu=7, do=1), trip(pu=5, do=5)])
    small = enrich(t, zones)
    big = enrich(t, zones, max_broadcast_rows=3)   # the lookup has 8 rows
    p_small = small._jdf.queryExecution().executedPlan().toString()
    p_big = big._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p_small
    assert "BroadcastHashJoin" not in p_big and "SortMergeJoin" in p_big
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))


def test_fits_broadcast_refuses_large_inputs_by_size(spark):
    nation = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    assert fits_broadcast(nation, 100)                       # 25 rows, small files
    assert not fits_broadcast(nation, 100, reject_bytes=100)


def _seq(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_result_order(make_trips, zones):
    t = make_trips([trip(business="Uber", date=OCT01, pay="9.00", length=1.0, tod="night"),
                    trip(business="Uber", date=JAN01, pu=5, pay="7.00", length=3.0),
                    trip(business="Uber", date=JAN01, pu=2, do=5, pay="7.00", length=3.0),
                    trip(business="Lyft", date=FEB28, pu=3, pay="8.00", length=2.0, tod="evening"),
                    trip(business="Uber", date=JAN01, pu=4, pay="7.00", length=3.0)]).repartition(3)
    months = [("Lyft", 2), ("Uber", 1), ("Uber", 10)]
    for q in (cat.monthly_summary, cat.q02_trips_per_business_month, cat.q03_profit_per_business_month,
              cat.q04_driver_pay_per_business_month):
        assert _seq(q(t), "business", "month") == months
    assert _seq(cat.q05_top_pickup_boroughs(t, zones), "Month", "Pickup_Borough") == [
        (1, "Queens"), (1, "Manhattan"), (2, "Bronx"), (10, "EWR")]
    assert _seq(cat.q06_top_dropoff_boroughs(t, zones, k=1), "Month", "Dropoff_Borough") == [
        (1, "Queens"), (2, "Queens"), (10, "Queens")]
    assert _seq(cat.q08_avg_pay_by_time_of_day(t), "time_of_day") == [("night",), ("evening",), ("morning",)]
    assert _seq(cat.q09_avg_length_by_time_of_day(t), "time_of_day") == [("morning",), ("evening",), ("night",)]
    w = make_trips([trip(date=JAN01 + 86400 * d, wait=float(d)) for d in (12, 3, 25, 3, 9)]).repartition(4)
    assert _seq(cat.q11_daily_wait(w), "day") == [(4,), (10,), (13,), (26,)]
    assert _seq(cat.q12_wait_anomaly_days(w, threshold=5.0), "day") == [(10,), (13,), (26,)]


def test_nested_triplets_equal_the_flat_ones(make_trips, zones):
    t = make_trips([trip(pu=1, do=2), trip(pu=1, do=2), trip(pu=5, do=6)])
    flat = {(r.src_id, r.dst_id): r for r in cat.q18_triplets(t, zones).collect()}
    rows = cat.q18_triplets_nested(t, zones).collect()
    assert len(rows) == len(flat) == 2
    for r in rows:
        f = flat[r.edge_src, r.edge_dst]
        assert r.edge_weight == f.weight
        assert all(r[f"{s}_{c}"] == f[f"{s}_{c}"] for s in ("src", "dst") for c in ("id", "Borough", "Zone", "service_zone"))


def test_schema_contract_checks_types(make_trips, zones):
    from tripcast.schema import ENRICHED_SCHEMA, assert_schema, schema_report
    out = cat.q01_enriched(make_trips([trip()]), zones)
    assert ("passenger_fare", "decimal(12,2)", True) in schema_report(out)
    with pytest.raises(AssertionError, match="schema mismatch"):
        assert_schema(out.withColumn("trip_length", out.trip_length.cast("float")), ENRICHED_SCHEMA)


def test_one_sided_routes_count_zero(make_trips, zones):
    t = make_trips([trip(business="Uber", pu=1, do=2), trip(business="Lyft", pu=3, do=4)])
    got = {r.Route: (r.uber_count, r.lyft_count) for r in cat.zone_routes_by_business(t, zones).collect()}
    assert set(got.values()) == {(1, 0), (0, 1)} and None not in got
