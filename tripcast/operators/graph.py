"""Zone graph: vertices, edges, triplets and the same-attribute motif.

A graph is two DataFrames.  The source has one edge per trip (a multigraph);
here edges are collapsed to ``(src, dst, weight)`` by one partial aggregation,
which bounds the edge table by the number of zone pairs (265^2 for the real
lookup) however many trips there are.  Every per-trip question is answered
from the weights (a per-trip count is the sum of weights).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.functions.measures import trips_in
from tripcast.operators.broadcast import checked_broadcast
from tripcast.schema import VERTEX_COLUMNS


@dataclass(frozen=True)
class Graph:
    vertices: DataFrame  # id, Borough, Zone, service_zone
    edges: DataFrame     # src, dst, weight


def vertices_from_zones(zones: DataFrame) -> DataFrame:
    """Zone lookup -> vertex table (id int, Borough, Zone, service_zone)."""
    return zones.select(F.col("LocationID").cast("int").alias("id"), "Borough", "Zone",
                        "service_zone")


def trip_edges(trips: DataFrame) -> DataFrame:
    """One edge per trip: (src, dst) = (pickup_location, dropoff_location)."""
    return trips.select(F.col("pickup_location").cast("int").alias("src"),
                        F.col("dropoff_location").cast("int").alias("dst"))


def trip_edge_weights(trips: DataFrame) -> DataFrame:
    """Parallel edges of trips, or of a trip summary, as one edge with ``weight`` = multiplicity."""
    return trips.groupBy(F.col("pickup_location").cast("int").alias("src"),
                         F.col("dropoff_location").cast("int").alias("dst")).agg(trips_in(trips).alias("weight"))


def build_graph(zones: DataFrame, trips: DataFrame) -> Graph:
    """Vertices from the lookup, weighted edges from the trips.  Edges whose
    endpoint is not a vertex are kept here; operators that need both
    endpoints drop them by their joins (see :func:`dangling_edge_count`)."""
    return Graph(vertices_from_zones(zones), trip_edge_weights(trips))


def _vertex_side(vertices: DataFrame, prefix: str) -> DataFrame:
    return checked_broadcast(vertices).select(
        *[F.col(c).alias(f"{prefix}_{c}") for c in VERTEX_COLUMNS])


def triplets_flat(g: Graph) -> DataFrame:
    """Edge with both endpoint rows, as flat columns:
    src_id, src_Borough, src_Zone, src_service_zone, weight,
    dst_id, dst_Borough, dst_Zone, dst_service_zone."""
    s = _vertex_side(g.vertices, "src")
    d = _vertex_side(g.vertices, "dst")
    return (g.edges.join(s, g.edges.src == s.src_id, "inner")
            .join(d, F.col("dst") == d.dst_id, "inner")
            .select(*[f"src_{c}" for c in VERTEX_COLUMNS], "weight",
                    *[f"dst_{c}" for c in VERTEX_COLUMNS]))


def triplets(g: Graph) -> DataFrame:
    """Triplets as three struct columns ``src``, ``edge``, ``dst``."""
    flat = triplets_flat(g)
    return flat.select(
        F.struct(*[F.col(f"src_{c}").alias(c) for c in VERTEX_COLUMNS]).alias("src"),
        F.struct(F.col("src_id").alias("src"), F.col("dst_id").alias("dst"),
                 F.col("weight")).alias("edge"),
        F.struct(*[F.col(f"dst_{c}").alias(c) for c in VERTEX_COLUMNS]).alias("dst"))


def same_attribute_pairs(g: Graph, attrs: tuple[str, ...] = ("Borough", "service_zone")
                         ) -> DataFrame:
    """Motif (a)-[]->(b) with a.attr = b.attr for every attr (NULL never
    equals NULL).  One row per connected pair: src_id, dst_id, the shared
    attributes, and ``trip_count`` (edges of the multigraph on that pair;
    self-loops included)."""
    t = triplets_flat(g)
    cond = F.lit(True)
    for a in attrs:
        cond = cond & (F.col(f"src_{a}") == F.col(f"dst_{a}"))
    return t.filter(cond).select(F.col("src_id"), F.col("dst_id"),
                                 *[F.col(f"dst_{a}").alias(a) for a in attrs],
                                 F.col("weight").alias("trip_count"))


def pair_summary(pairs: DataFrame) -> DataFrame:
    """One row: number of distinct connected pairs and of trips on them
    (the motif count of the per-trip multigraph)."""
    return pairs.agg(F.count(F.lit(1)).alias("pair_count"),
                     F.coalesce(F.sum("trip_count"), F.lit(0)).cast("long").alias("trip_count"))


def dangling_edge_count(g: Graph) -> DataFrame:
    """One row: weighted edges and trips whose src or dst is not a vertex."""
    ids = checked_broadcast(g.vertices.select(F.col("id")))
    e = (g.edges
         .join(ids.select(F.col("id").alias("src"), F.lit(True).alias("_s")), "src", "left")
         .join(ids.select(F.col("id").alias("dst"), F.lit(True).alias("_d")), "dst", "left"))
    bad = F.col("_s").isNull() | F.col("_d").isNull()
    return e.agg(F.count_if(bad).alias("dangling_edges"),
                 F.coalesce(F.sum(F.when(bad, F.col("weight"))), F.lit(0)).cast("long")
                 .alias("dangling_trips"))
