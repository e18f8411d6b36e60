"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for all nodes of the links ``a``, ``b``.

    Each round takes the smallest label of the neighbours and then the label of that label, which doubles the distance
    that labels travel. Neighbours are reduced to a minimum in each task before they move, so a node with many links
    doesn't matter. Labels are written in every round; nothing comes to the driver but the number of changes.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("_node")).agg(F.min("component").alias("_near"))
        step = labels.join(near, labels.node == near._node, "left").select(
            "node", "component", F.least("component", F.coalesce("_near", "component")).alias("_next"))
        jump = labels.select(F.col("node").alias("_at"), F.col("component").alias("_far"))
        step = step.join(jump, step._next == jump._at, "left").select(
            "node", F.least("_next", F.coalesce("_far", "_next")).alias("_next"), F.col("component").alias("_old"))
        step = stored(step, "labels")
        labels = step.select("node", F.col("_next").alias("component"))
        if step.where("_next <> _old").isEmpty():
            return labels
