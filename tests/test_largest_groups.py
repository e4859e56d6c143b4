"""The groups with the most rows, bounded before they are grouped."""
import random

import pytest
from pyspark.sql import functions as F

from tripcast.operators.topk import largest_groups, top_k
from tripcast.plans import catalogue as cat


def _rows(spark, n_groups, heavy, seed=1):
    rng = random.Random(seed)
    rows = [(f"g{i}", rng.choice("ab")) for i in range(n_groups) for _ in range(rng.randrange(1, 4))]
    rows += [(f"h{i}", "a") for i, n in enumerate(heavy) for _ in range(n)]
    return spark.createDataFrame(rows, "g string, c string"), rows


@pytest.mark.parametrize("heavy", [[40, 30, 20], [], [9] * 30])
@pytest.mark.parametrize("buckets", [1 << 20, 64, 1])
def test_top_groups_are_the_same(spark, heavy, buckets):
    df, _ = _rows(spark, 500, heavy)
    best = lambda d: [tuple(r) for r in top_k(d.groupBy("g").agg(F.count(F.lit(1)).alias("n")), [F.desc("n"), "g"], 5).collect()]
    assert best(largest_groups(df, ["g"], 5, buckets=buckets)) == best(df)
    only = df.filter("c = 'a'")
    assert best(largest_groups(df, ["g"], 5, F.col("c") == "a", buckets).filter("c = 'a'")) == best(only)


def test_few_rows_are_left_to_group(spark):
    df, rows = _rows(spark, 5000, [40, 30, 20, 15, 12, 11])
    left = largest_groups(df, ["g"], 5).count()
    assert 117 <= left < 0.05 * len(rows)  # the rest never reaches the grouping shuffle
    assert largest_groups(df.limit(0), ["g"], 5).count() == 0
    assert largest_groups(df.filter("g = 'h0'"), ["g"], 5).count() == 40


def test_bounded_routes_equal_the_plain_query(spark, make_trips, zones):
    from tests.conftest import trip
    rng = random.Random(4)
    place = lambda: rng.choice([1, 2, 3, 4, 5, 6, 264, 999, None])
    trips = make_trips([trip(business=rng.choice(["Uber", "Lyft", "Other"]), pu=place(), do=place()) for _ in range(400)])
    for k in (1, 3, 10, 100):
        got, want = [[tuple(r) for r in f(trips, zones, k=k).collect()] for f in (cat.q16_top_routes_bounded, cat.q16_top_zone_routes)]
        assert got == want
