"""Join of a large table with a lookup that is too large to broadcast.

A sort-merge join sends all rows of a key to one task.  Here the keys that hold
more than their share of the rows are found by one partial aggregate; their few
lookup rows are broadcast and those facts never move, and only the rest is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tripcast.operators.broadcast import checked_broadcast

MOST_HEAVY = 1000  # no key below half of 1 / MOST_HEAVY of all rows is heavy


def heavy_keys(facts: DataFrame, key: str, share: float | None = None) -> list:
    """Keys that hold more than ``share`` of the rows (default: a shuffle partition's
    share, at least 1 / MOST_HEAVY), so at most 1 / share of them.  One scan of the
    key column, summed inside tasks before the shuffle."""
    if share is None:
        share = max(1 / int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 / MOST_HEAVY) / 2
    seen = Observation()
    counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    most = counts.observe(seen, F.sum("n").alias("rows")).orderBy(F.desc("n"), key).limit(int(1 / share)).collect()
    return [r[0] for r in most if r["n"] > seen.get["rows"] * share]


def split_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "inner", heavy: list | None = None) -> DataFrame:
    """``facts.join(lookup, key, how)`` for an inner or left join; ``heavy`` as
    :func:`heavy_keys` gives them (found here if None)."""
    if how not in ("inner", "left"):
        raise ValueError(f"an inner or left join can be split, not {how}")
    heavy = heavy_keys(facts, key) if heavy is None else heavy
    if not heavy:
        return facts.join(lookup, key, how)
    is_heavy = F.coalesce(F.col(key).isin(heavy), F.lit(False))
    few = checked_broadcast(lookup.filter(F.col(key).isin(heavy)))
    columns = [c for c in facts.columns if c != key]
    out = facts.filter(is_heavy).join(few, key, how).unionByName(facts.filter(~is_heavy).join(lookup, key, how))
    return out.select(key, *columns, *[c for c in lookup.columns if c != key])
