"""PageRank run until the per-vertex change falls below a tolerance.

Semantics (the public tolerance-driven PageRank of Spark's graph library,
which the source analysis calls with reset probability 0.17 and tol 0.01):

1. Every vertex starts with rank = delta = r (reset probability).
2. Each round, every vertex that changed in the previous round and whose
   delta exceeds ``tol`` sends delta * w(s,d) / outdeg(s) along each out-edge
   (w = multiplicity, outdeg = sum of w).  A vertex that receives a total m
   adds (1 - r) * m to its rank; its new delta is the change.  Vertices that
   receive nothing keep their rank and stop sending.
3. Stop when no vertex sends; scale all ranks so they sum to the number of
   vertices (this corrects for sinks).

Spark plan.  Weighted edges are collapsed once (partial aggregation, so a hot
zone pair holding a third of all trips is folded map-side) and turned into
"links": every out-edge with its share p = w / outdeg(src), plus one self link
per vertex that carries the vertex's own state forward.  One round is

    state(id, rank, delta, active)  JOIN  links ON src = id
      -> per target: own rank/delta (self link) and the sum of messages
      -> GROUP BY target (partial + final aggregate, one shuffle)

so each round reads the previous state exactly once and the plan grows
linearly with the rounds.  ``rounds_per_job`` rounds are chained into one
Spark SQL statement (one CTE per round over temp views of the stored state and
links, analysed once) and written to the shared checkpoint folder, which also
cuts the lineage: a lost executor recomputes at most those rounds.  Rounds after convergence change nothing (nobody sends), so checking
for convergence every few rounds gives exactly the stop-at-once result.

Each round shuffles the state (one row per vertex and salt), the links (bounded
by the number of distinct zone pairs plus vertices, independent of the number
of trips) and the map-side pre-aggregated messages.  The out-edges of a hub are
dealt over ``ceil(out-edges / LINKS_PER_SALT)`` salts by their target, its
state is repeated as often, and out-degrees are a plain aggregate joined back,
so no task ever holds all edges of one vertex.  State and links are Parquet in
the shared checkpoint folder; all but the last state are deleted at the end.
Only a convergence flag per job and the final rank sum reach the driver.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.operators.broadcast import checked_broadcast
from tripcast.session import ensure_checkpoint_dir

DEFAULT_RESET = 0.17
DEFAULT_TOL = 0.01
# Deltas shrink by about (1 - r) per hop, so with r = 0.17 and tol = 0.01
# about 16 rounds send messages: ten rounds per job finish in two jobs, and
# measured faster than 8 (three jobs) or 12 (deeper plans to optimise).
ROUNDS_PER_JOB = 10
LINKS_PER_SALT = 100_000


def round_bound(reset: float, tol: float, vertices: int) -> int:
    """Rounds after which nobody can send: the deltas of all vertices together
    are at most ``vertices * reset`` and shrink by (1 - reset) a round, and a
    vertex sends only while its own exceeds ``tol``."""
    return max(1, math.ceil(math.log(tol / (vertices * reset)) / math.log1p(-reset))) + 1


class _Store:
    """Parquet tables of one run in the shared checkpoint folder."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pagerank-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _weighted_shares(ids: DataFrame, edges: DataFrame) -> DataFrame:
    """(src, dst, p, salts): p = w(src,dst) / outdeg(src) over edges with both
    endpoints in ``ids`` (broadcast where measured small), salts = the number
    of parts the out-edges of src are dealt over."""
    e = edges.select(F.col("src").cast("long").alias("src"),
                     F.col("dst").cast("long").alias("dst"),
                     (F.col("weight") if "weight" in edges.columns else F.lit(1))
                     .cast("double").alias("w"))
    side = checked_broadcast(ids)
    e = (e.join(side.select(F.col("id").alias("src")), "src", "left_semi")
          .join(side.select(F.col("id").alias("dst")), "dst", "left_semi")
          .groupBy("src", "dst").agg(F.sum("w").alias("w")))
    out = e.groupBy("src").agg(F.sum("w").alias("outdeg"),
                               F.ceil(F.count(F.lit(1)) / LINKS_PER_SALT).cast("int").alias("salts"))
    return e.join(out, "src").select("src", "dst", (F.col("w") / F.col("outdeg")).alias("p"), "salts")


def _rounds_sql(state_view: str, links_view: str, rounds: int, keep: float, tol: float) -> str:
    """``rounds`` chained rounds as one SQL statement, one CTE per round.

    A round joins the state (id, rank, delta, active, salts), once per salt,
    with the links (src, salt, dst, p) and aggregates per dst: the self link (p NULL)
    carries the vertex's own rank, delta and number of salts, the other links
    carry the messages of active senders whose delta exceeds tol.  One statement is
    analysed once, instead of once per DataFrame call on an ever longer plan.
    Literals are written as exact doubles (``D`` suffix, shortest repr)."""
    k, t = f"{keep!r}D", f"{tol!r}D"
    ctes = []
    prev = state_view
    for i in range(1, rounds + 1):
        cur = f"r{i}"
        ctes.append(f"""{cur} AS (
  SELECT id,
         CASE WHEN msg IS NOT NULL THEN rank0 + {k} * msg ELSE rank0 END AS rank,
         CASE WHEN msg IS NOT NULL THEN (rank0 + {k} * msg) - rank0 ELSE delta0 END AS delta,
         msg IS NOT NULL AS active, salts
  FROM (
    SELECT l.dst AS id,
           max(CASE WHEN l.p IS NULL THEN s.rank END) AS rank0,
           max(CASE WHEN l.p IS NULL THEN s.delta END) AS delta0,
           max(CASE WHEN l.p IS NULL THEN s.salts END) AS salts,
           sum(CASE WHEN l.p IS NOT NULL AND s.active AND s.delta > {t}
                    THEN s.delta * l.p END) AS msg
    FROM (SELECT *, explode(sequence(0, salts - 1)) AS salt FROM {prev}) s
    JOIN {links_view} l ON l.src = s.id AND l.salt = s.salt
    GROUP BY l.dst) agg_{i}
)""")
        prev = cur
    return "WITH " + ",\n".join(ctes) + f"\nSELECT id, rank, delta, active, salts FROM {prev}"


def pagerank(vertices: DataFrame, edges: DataFrame, reset: float = DEFAULT_RESET,
             tol: float = DEFAULT_TOL,
             rounds_per_job: int = ROUNDS_PER_JOB) -> DataFrame:
    """vertices(id, ...), edges(src, dst[, weight]) -> (id int, pagerank double).

    Edges whose src or dst is not a vertex are ignored.  Requires
    0 < reset < 1 and tol > 0.
    """
    if not 0.0 < reset < 1.0:
        raise ValueError(f"reset probability must be in (0, 1), got {reset}")
    if not tol > 0.0:
        raise ValueError(f"tolerance must be positive, got {tol}")
    spark = vertices.sparkSession
    store = _Store(spark)
    keep = 1.0 - reset

    ids = store.put(vertices.select(F.col("id").cast("long").alias("id")).distinct(), "ids")
    n_vertices = ids.count()
    if n_vertices == 0:
        return spark.createDataFrame([], "id int, pagerank double")

    shares = store.put(_weighted_shares(ids, edges), "shares")
    sources = shares.groupBy(F.col("src").alias("id")).agg(F.first("salts").alias("salts"))
    # Round 0 applied to every vertex: rank = delta = (1 - r) * (r / (1 - r)).
    start = keep * (reset / keep)
    state = store.put(ids.join(sources, "id", "left").select(
        "id", F.lit(start).alias("rank"), F.lit(start).alias("delta"), F.lit(True).alias("active"),
        F.coalesce("salts", F.lit(1)).alias("salts")), "state-0")
    own = ids.select(F.col("id").alias("src"), F.lit(0).alias("salt"), F.col("id").alias("dst"),
                     F.lit(None).cast("double").alias("p"))
    links = store.put(shares.select(
        "src", F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int").alias("salt"), "dst", "p").unionByName(own), "links")

    tag = uuid.uuid4().hex[:12]
    links_view, state_view = f"tripcast_pr_links_{tag}", f"tripcast_pr_state_{tag}"
    links.createOrReplaceTempView(links_view)
    rounds, bound = 0, round_bound(reset, tol, n_vertices)
    while True:
        state.createOrReplaceTempView(state_view)
        state = store.put(spark.sql(_rounds_sql(state_view, links_view, rounds_per_job, keep, tol)),
                          f"state-{rounds + rounds_per_job}")
        store.drop(f"state-{rounds}")
        rounds += rounds_per_job
        if rounds >= bound or state.filter(F.col("active")).isEmpty():
            break

    spark.catalog.dropTempView(state_view)
    spark.catalog.dropTempView(links_view)
    for name in ("ids", "shares", "links"):
        store.drop(name)
    total = state.agg(F.sum("rank").alias("s")).first()["s"]
    factor = float(n_vertices) / float(total)
    return state.select(F.col("id").cast("int").alias("id"),
                        (F.col("rank") * F.lit(factor)).alias("pagerank"))
