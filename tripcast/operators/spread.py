"""Shuffles with as many tasks as the rows need.

A shuffle that the planner adds has a fixed number of partitions, and adaptive
execution joins small ones until there are about as many as cores; where nearly every
row is a group of its own, a task's sorts and hash tables then grow with the
table.  Here the number of tasks follows from the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

ROWS_PER_TASK = 500_000


def task_count(rows: DataFrame) -> int | None:
    """Tasks of at most ROWS_PER_TASK rows each, at least one per core; None for
    rows that one such task holds: the planner's own shuffles do for them.  Counts
    ``rows``, so it should be a table, counted by its file footers."""
    n = -(-rows.count() // ROWS_PER_TASK)
    return max(n, rows.sparkSession.sparkContext.defaultParallelism) if n > 1 else None


def spread(df: DataFrame, tasks: int | None, *keys: str | Column) -> DataFrame:
    """``df`` hashed by ``keys`` over ``tasks`` tasks, so that a join or grouping by
    them needs no shuffle of its own; unchanged for None."""
    return df if tasks is None else df.repartition(tasks, *keys)
