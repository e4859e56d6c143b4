"""Invariants across registered queries on the smallest test tables: group
counts add up to the input, per-business counts add up to totals, ranks add
up to the vertex count, top-k results are part of the full result."""

import os

import pytest

import __spark_entry__ as ent

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def q():
    return ent.queries()


def _rows(spark, q, name):
    return q[name](spark, SF).collect()


def test_every_trip_is_enriched(spark, q):
    c = _rows(spark, q, "q01_row_count")[0]
    lineitems = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert c.trips == lineitems == c.enriched_rows
    assert c.pickup_unmatched == 0 and c.dropoff_unmatched == 0
    assert q["q01_enriched"](spark, SF).count() == c.enriched_rows


def test_monthly_counts_add_up(spark, q):
    total = _rows(spark, q, "q01_row_count")[0].trips
    monthly = _rows(spark, q, "q02_04_monthly_summary")
    assert sum(r.trip_count for r in monthly) == total
    assert {r.business for r in monthly} <= {"Uber", "Lyft"}
    pay = sum(r.total_driver_pay for r in monthly)
    profit = sum(r.total_profit for r in monthly)
    routes = _rows(spark, q, "q07_top_routes_by_pay")
    assert len(routes) <= 30
    assert sum(r.total_profit for r in routes) == pytest.approx(pay)  # 25 routes <= 30
    assert profit > 0


def test_route_counts_add_up(spark, q):
    total = _rows(spark, q, "q01_row_count")[0].trips
    routes = _rows(spark, q, "q16_zone_routes")
    assert all(r.uber_count + r.lyft_count == r.total_count for r in routes)
    assert sum(r.total_count for r in routes) == total
    top = _rows(spark, q, "q16_top_zone_routes")
    full = {tuple(r) for r in routes}
    assert {tuple(r) for r in top} <= full
    assert min(r.total_count for r in top) >= max(
        [r.total_count for r in routes if tuple(r) not in {tuple(t) for t in top}] or [0])


def test_top_boroughs_within_full_counts(spark, q):
    top = _rows(spark, q, "q05_top_pickup_boroughs")
    by_month = {}
    for r in top:
        by_month.setdefault(r.Month, []).append(r.trip_count)
    assert all(len(v) <= 5 for v in by_month.values())
    assert sum(sum(v) for v in by_month.values()) <= _rows(spark, q, "q01_row_count")[0].trips


def test_graph_invariants(spark, q):
    total = _rows(spark, q, "q01_row_count")[0].trips
    weights = _rows(spark, q, "q17_edge_weights")
    assert sum(r.weight for r in weights) == total == q["q17_edges"](spark, SF).count()
    pr = _rows(spark, q, "q20_pagerank")
    n = len(_rows(spark, q, "q17_vertices"))
    assert len(pr) == n
    assert sum(r.pagerank for r in pr) == pytest.approx(n, abs=1e-4)
    top = _rows(spark, q, "q20_pagerank_top5")
    assert [r.id for r in top] == [r.id for r in sorted(pr, key=lambda r: (-r.pagerank, r.id))][:5]
    pairs = _rows(spark, q, "q19_same_borough_service_zone_pairs")
    c = _rows(spark, q, "q19_pair_count")[0]
    assert c.pair_count == len(pairs) and c.trip_count == sum(r.trip_count for r in pairs)


def test_thresholds_subset(spark, q):
    daily = {r.day: r.average_wait for r in _rows(spark, q, "q11_january_daily_wait")}
    hot = {r.day for r in _rows(spark, q, "q12_wait_anomaly_days")}
    assert hot == {d for d, v in daily.items() if v > 50.0}
    low = _rows(spark, q, "q13_low_volume_pickups_2000")
    assert all(0 < r.trip_count < 2000 for r in low)
