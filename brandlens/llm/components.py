"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of the component of each node of the edges (a, b).

    Each round gives a node the smallest label around it and then that label's own label, so that
    the number of rounds grows with the logarithm of a chain's length. Rounds are written to the
    shared folder. Minima are taken before the shuffle, so a node of many edges is no hot key.
    """
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a != b").distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        met = labels.join(around, "node").select("node", "label", F.least("label", "near").alias("new"))
        # Hooking: the old label's node takes the new label as well.
        hooks = met.groupBy(F.col("label").alias("node")).agg(F.min("new").alias("hook"))
        moved = met.join(hooks, "node", "left").select("node", "label", F.least("new", F.coalesce("hook", "new")).alias("new"))
        jump = moved.select(F.col("node").alias("new"), F.col("new").alias("root"))
        after = staged(moved.join(jump, "new", "left").select("node", "label", F.least("new", F.coalesce("root", "new")).alias("new")), "labels")
        changed = after.filter("label != new").limit(1).count()
        labels = after.select("node", F.col("new").alias("label"))
        if not changed:
            return labels
