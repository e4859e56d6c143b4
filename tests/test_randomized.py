"""Seeded randomized comparisons of operators with plain-Python models."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import trip
from tests.test_graph import _brute_pagerank
from tripcast.operators.pagerank import pagerank
from tripcast.operators.topk import top_k_per_group
from tripcast.plans import catalogue as cat


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pagerank_random_multigraphs(spark, seed):
    rnd = random.Random(seed)
    n = rnd.randint(3, 12)
    edges = [(rnd.randrange(n + 2), rnd.randrange(n)) for _ in range(rnd.randint(5, 60))]
    reset, tol = rnd.choice([(0.17, 0.01), (0.15, 0.001), (0.3, 0.05)])
    v = spark.createDataFrame([(i,) for i in range(n)], "id int")
    e = spark.createDataFrame(edges, "src int, dst int")
    got = {r.id: r.pagerank for r in pagerank(v, e, reset=reset, tol=tol).collect()}
    want = _brute_pagerank(range(n), edges, reset=reset, tol=tol)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("seed", [7, 8])
def test_zone_routes_random(spark, make_trips, zones, seed):
    rnd = random.Random(seed)
    ids = [1, 2, 3, 4, 5, 6, 264, 265, 99]          # 99 is not in the lookup
    rows = [trip(business=rnd.choice(["Uber", "Lyft", "Other"]),
                 pu=rnd.choice(ids), do=rnd.choice(ids)) for _ in range(200)]
    names = {r.LocationID: r.Zone for r in zones.collect()}
    want: dict[str, Counter] = {}
    for r in rows:
        b, pu, do = r[0], r[1], r[2]
        if pu in names and do in names and b in ("Uber", "Lyft"):
            want.setdefault(f"{names[pu]} to {names[do]}", Counter())[b] += 1
    got = {r.Route: (r.uber_count, r.lyft_count, r.total_count)
           for r in cat.zone_routes_by_business(make_trips(rows), zones).collect()}
    assert got == {k: (c["Uber"], c["Lyft"], c["Uber"] + c["Lyft"]) for k, c in want.items()}


@pytest.mark.parametrize("seed", [11, 12])
def test_top_k_per_group_random(spark, seed):
    rnd = random.Random(seed)
    rows = [(f"b{rnd.randrange(8)}", rnd.randrange(4), rnd.randrange(5)) for _ in range(40)]
    rows = list({(b, m): (b, m, c) for b, m, c in rows}.values())   # one row per (b, m)
    df = spark.createDataFrame(rows, "b string, m int, c int")
    got = sorted(tuple(r) for r in
                 top_k_per_group(df, ["m"], [F.desc("c"), F.asc("b")], 3).collect())
    want = []
    for m in {r[1] for r in rows}:
        grp = sorted((r for r in rows if r[1] == m), key=lambda r: (-r[2], r[0]))
        want += grp[:3]
    assert got == sorted(want)


def test_calendar_random_against_python(spark):
    import datetime as dt

    from tripcast.functions.calendar import day_of, iso_date, month_of
    rnd = random.Random(5)
    secs = [rnd.randint(-10**9, 2 * 10**9) for _ in range(300)] + [0, -1, 86399, 86400]
    df = spark.createDataFrame([(s,) for s in secs], "date long")
    got = {r.date: (r.d, r.m, r.dd) for r in
           df.select("date", iso_date("date").alias("d"), month_of("date").alias("m"),
                     day_of("date").alias("dd")).collect()}
    epoch = dt.datetime(1970, 1, 1)
    for s in secs:
        want = epoch + dt.timedelta(seconds=s)
        assert got[s] == (want.strftime("%Y-%m-%d"), want.month, want.day), s


@pytest.mark.parametrize("seed", [21, 22])
def test_monthly_measures_random(spark, make_trips, seed):
    from decimal import Decimal

    from tripcast.operators.aggregate import monthly_measures
    rnd = random.Random(seed)
    rows, want = [], {}
    for _ in range(150):
        b = rnd.choice(["Uber", "Lyft"])
        month = rnd.randint(1, 12)
        date = int(datetime.datetime(2023, month, rnd.randint(1, 28),
                                     tzinfo=datetime.timezone.utc).timestamp())
        profit = Decimal(rnd.randint(-5000, 5000)) / 100
        pay = Decimal(rnd.randint(0, 9000)) / 100
        rows.append(trip(business=b, date=date, profit=str(profit), pay=str(pay)))
        w = want.setdefault((b, month), [0, Decimal(0), Decimal(0)])
        w[0] += 1
        w[1] += profit
        w[2] += pay
    got = {(r.business, r.month): (r.trip_count, r.total_profit, r.total_driver_pay)
           for r in monthly_measures(make_trips(rows)).collect()}
    assert got == {k: (v[0], float(v[1]), float(v[2])) for k, v in want.items()}
