"""Top-k per group and global top-k with deterministic tie-breaking.

``row_number() <= k`` over a window is planned by Spark as a partial
``WindowGroupLimit`` before the shuffle and a final one after it, so each
task forwards at most k rows per group.  A global ``orderBy().limit(k)`` is
planned as ``TakeOrderedAndProject``: every task keeps its own k best rows and
only those reach the final merge, no full sort.

:func:`largest_groups` answers "the k groups with the most rows" where groups are
as many as rows, so that a plain aggregate would shuffle them all.  Every row is
first counted in one of ``buckets`` hash buckets, whose total bounds each group in
it from above; the exact counts of the groups in the fullest buckets give a count that k
groups reach; only rows of buckets that reach it as well are grouped.

Ties are broken by the extra ordering columns so the same input always gives
the same k rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripcast.operators.broadcast import checked_broadcast


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k_per_group(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str | Column],
                    k: int, rank_col: str | None = None) -> DataFrame:
    """Keep the first ``k`` rows of each partition in ``order_by`` order.
    ``order_by`` must end with columns that make the order total."""
    w = Window.partitionBy(*partition_by).orderBy(*_order(order_by))
    name = rank_col or "_rank"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def top_k(df: DataFrame, order_by: Sequence[str | Column], k: int) -> DataFrame:
    """Global top-k (sort + limit, planned as TakeOrderedAndProject)."""
    return df.orderBy(*_order(order_by)).limit(k)


def largest_groups(rows: DataFrame, keys: Sequence[str], k: int, counted: Column | None = None, buckets: int = 1 << 20) -> DataFrame:
    """The rows of ``rows`` whose group by ``keys`` may be one of the ``k`` with the
    most rows (for which ``counted`` holds), and all rows of those that are.

    Runs two jobs: one counts buckets, at most ``buckets`` numbers a task and at the
    driver, one the groups of the fullest buckets.  What it returns is grouped by
    the caller; groups that tie with the k-th are all among them."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    mine = rows if counted is None else rows.filter(counted)
    totals = mine.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    at, n = totals.column("b").to_numpy(), totals.column("n").to_numpy()
    if len(at) <= k:
        return rows
    fullest = at[np.lexsort((at, -n))[:k]].tolist()
    counts = mine.filter(bucket.isin(fullest)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    reached = sorted((r["n"] for r in top_k(counts, [F.desc("n"), *keys], k).collect()), reverse=True)
    least = reached[k - 1] if len(reached) >= k else 0
    left = at[n >= least]
    if len(left) == len(at):
        return rows
    side = rows.sparkSession.createDataFrame([(int(b),) for b in left.tolist()], "b long")
    return rows.withColumn("__b", bucket).join(checked_broadcast(side), F.col("__b") == F.col("b"), "left_semi").drop("__b")


def row_digest(columns: Sequence[str]) -> Column:
    """MD5 of the columns' text, a pseudo-random order that any engine repeats.
    Doubles print differently between engines; leave them out."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def sample_rows(df: DataFrame, n: int, by: Sequence[str] | None = None) -> DataFrame:
    """A reproducible sample of ``n`` rows: the first ``n`` by the digest of the
    columns ``by`` (default: all), so it is spread over the rows rather than a
    run of equal ones (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(row_digest(by or df.columns)).limit(n)
