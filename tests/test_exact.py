import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tripcast.functions.exact import exact_double_avg, exact_double_sum, merged, partial_sums


def _sum(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return df.agg(exact_double_sum("x").alias("s"), exact_double_avg("x").alias("a")).first()


@pytest.mark.parametrize("seed", range(3))
def test_sum_is_the_correctly_rounded_exact_sum(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randrange(0, 12) for _ in range(400)] + [1e15, -1e15, 0.1, 0.2, 0.3]
    want = float(sum(map(Fraction, values)))
    for parts in (1, 3, 8):
        for order in (values, sorted(values), values[::-1]):
            got = _sum(spark, order, parts)
            assert got["s"] == want
            assert got["a"] == want / len(values)


def test_order_does_not_matter_where_plain_sums_differ(spark):
    values = [1e16, 1.0, -1e16, 1.0] * 25
    assert _sum(spark, values, 4)["s"] == 50.0


def test_nulls_nothing_and_numbers_beyond_the_range(spark):
    assert _sum(spark, [None, None], 1)["s"] is None and _sum(spark, [None], 1)["a"] is None
    assert _sum(spark, [], 1)["s"] is None
    assert _sum(spark, [None, 2.5, -0.5], 2)["s"] == 2.0
    assert _sum(spark, [1e300, 1.0], 2)["s"] == 1e300
    assert math.isnan(_sum(spark, [float("nan"), 1.0], 2)["s"])
    assert _sum(spark, [float("inf"), 1.0], 2)["s"] == math.inf
    assert abs(_sum(spark, [1e-300] * 10, 2)["s"]) < 1e-18  # below 2^-62 fractions are cut


def test_partial_sums_add_up(spark):
    rng = random.Random(9)
    values = [rng.uniform(-1000, 1000) for _ in range(300)]
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(values)], "g int, x double")
    parts = df.groupBy("g").agg(*[c.alias(n) for n, c in zip("wfo", partial_sums("x"))])
    total = parts.agg(merged(F.sum("w"), F.sum("f"), F.sum("o")).alias("s")).first()["s"]
    assert total == float(sum(map(Fraction, values)))
