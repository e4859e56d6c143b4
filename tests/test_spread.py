"""Routes as many as trips, dealt over as many tasks as the trips need."""
import random
import re
from collections import Counter

import pytest

from tripcast.operators import enrich as en
from tripcast.operators import spread as sp
from tripcast.plans import catalogue as cat
from tripcast.plans.registry import QUERIES


def test_tasks_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(sp, "ROWS_PER_TASK", 10)
    assert [sp.task_count(spark.range(n)) for n in (0, 10, 11, 95, 1000)] == [None, None, 4, 10, 100]
    df = spark.range(100)
    assert sp.spread(df, None, "id") is df
    assert sp.spread(df, 7, "id").rdd.getNumPartitions() == 7


@pytest.mark.parametrize("small", [True, False])
def test_dealt_routes_equal_the_plain_ones(spark, make_trips, zones, monkeypatch, small):
    from tests.conftest import trip
    rng = random.Random(6)
    place = lambda: rng.choice([1, 2, 3, 4, 5, 6, 264, 999, None])
    trips = make_trips([trip(business=rng.choice(["Uber", "Lyft", "Other", None]), pu=place(), do=place()) for _ in range(400)])
    zones = zones.unionByName(zones.filter("LocationID = 3"))  # an id that comes twice
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    want, top = rows(cat.zone_routes_by_business(trips, zones)), cat.q16_top_zone_routes(trips, zones).collect()
    if not small:
        monkeypatch.setattr(en, "fits_broadcast", lambda *a: False)
        monkeypatch.setattr(en, "lookup_side", lambda z, *a: z)
    assert rows(cat.zone_routes_by_business(trips, zones, tasks=9)) == want
    assert cat.q16_top_zone_routes(trips, zones, tasks=9).collect() == top


def _tables(spark, folder, lines):
    """Orders of up to four lines; every seventh line without supplier, some without order."""
    rng = random.Random(7)
    li = [(n // 4 if n % 50 else None, rng.randrange(90) if n % 7 else None, rng.choice("FOX")) for n in range(lines)]
    orders = [(i, rng.randrange(300)) for i in range(0, lines // 4, 1) if i % 11]
    spark.createDataFrame(li, "l_orderkey long, l_suppkey long, l_linestatus string").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(i, f"S{i % 80}") for i in range(85)], "s_suppkey long, s_name string").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(i, f"C{i}") for i in range(290)], "c_custkey long, c_name string").write.parquet(f"{folder}/customer.parquet")
    customer, out = dict(orders), Counter()
    for order, supplier, status in li:
        if order in customer and supplier is not None and supplier < 85 and customer[order] < 290 and status != "X":
            out[f"S{supplier % 80} to C{customer[order]}", status] += 1
    return {r: (out[r, "F"], out[r, "O"], out[r, "F"] + out[r, "O"]) for r, _ in out}


def test_supplier_customer_routes_take_tasks_by_their_lines(spark, tmp_path, monkeypatch):
    want = _tables(spark, str(tmp_path), 6000)
    first = sorted(((-v[2], r, *v) for r, v in want.items()))[:10]
    for most, tasks in ((250, 24), (10_000, None)):
        monkeypatch.setattr(sp, "ROWS_PER_TASK", most)
        routes = QUERIES["q16_supplier_customer_routes"](spark, str(tmp_path))
        assert {r[0]: tuple(r)[1:] for r in routes.collect()} == want
        top = QUERIES["q16_top_supplier_customer_routes"](spark, str(tmp_path))
        assert [tuple(r) for r in top.collect()] == [x[1:] for x in first]
        for df in (routes, top):
            plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            shuffles = re.findall(r"Exchange hashpartitioning\((.*?), (\d+)\)", plan)
            assert len(shuffles) >= 4  # lines, orders, pairs, routes
            assert all(int(n) == (tasks or 4) for _, n in shuffles), shuffles
            assert any("Route" in keys for keys, _ in shuffles)
