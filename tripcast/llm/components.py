"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.llm.common import n_shuffle, stored


def _small(df: DataFrame, what: str) -> DataFrame:
    """Store a table of ids in few files: it is thousands of times smaller than
    the texts the number of shuffle partitions is meant for."""
    return stored(df.coalesce(max(1, n_shuffle(df.sparkSession) // 16)), what)


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for every vertex of ``edges`` (a, b): the least vertex of its
    component.  Every round sends each vertex to its least neighbour and
    contracts the graph by that, which at least halves what is left of a
    component, so rounds grow with the logarithm of its size.  All state stays
    in Spark; each round is written to the shared folder."""
    left = _small(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    rounds = []
    while not left.isEmpty():
        both = left.select(F.col("a").alias("v"), F.col("b").alias("n")).union(left.select("b", "a"))
        to = _small(both.groupBy("v").agg(F.least("v", F.min("n")).alias("p")), "parents")
        rounds.append(to)
        pa, pb = to.select(F.col("v").alias("a"), F.col("p").alias("x")), to.select(F.col("v").alias("b"), F.col("p").alias("y"))
        left = _small(left.join(pa, "a").join(pb, "b").filter("x <> y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not rounds:
        return left.select(F.col("a").alias("v"), F.col("b").alias("label"))
    labels = rounds[0].select("v", F.col("p").alias("label"))
    for to in rounds[1:]:
        step = to.select(F.col("v").alias("label"), "p")
        labels = labels.join(step, "label", "left").select("v", F.coalesce("p", "label").alias("label"))
    return _small(labels, "labels")
