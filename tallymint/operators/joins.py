"""Joining a large table with a list whose size is not known beforehand."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def rollup_listed(rows: DataFrame, listed: DataFrame, on: str, keys: list[str], measures: dict,
                  how: str = "left_semi") -> DataFrame:
    """Sums by ``keys`` of the rows whose ``on`` value is in a list.

    The rows are summed by ``on`` and ``keys`` first, within each task before anything moves: then even a value that holds
    a third of all rows arrives as a few rows per task, and the join with the list sees one row per group. Whether the
    list is broadcast is left to the planner, which knows its size by then. No job runs while the plan is built.

    ``measures`` maps a name to the aggregate that feeds it; each must be a sum or a count, so that
    partial results add up.
    """
    small = rows.groupBy(on, *keys).agg(*[expr.alias(name) for name, expr in measures.items()])
    return small.join(listed, on, how).groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures])
