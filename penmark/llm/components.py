"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.llm.common import join_groups, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) of every node of ``edges`` (``a``, ``b``).

    Every round each node takes the smallest label around it, then its label's label.
    A node with very many edges is joined by broadcast and aggregated before the shuffle.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(
        F.count("*").alias("degree"), F.least(F.col("node"), F.min("b")).alias("component")
    )
    labels = stored(labels, "labels")
    while True:
        seen = join_groups(both, labels.withColumnRenamed("node", "a"), "a", "degree", F.xxhash64("b"))
        around = seen.groupBy(F.col("b").alias("node")).agg(F.min("component").alias("around"))
        nearer = labels.join(around, "node").select(
            "node", "degree", F.least("component", "around").alias("label"), F.col("component").alias("old")
        )
        # How many nodes share a label says which labels are hot in the next join.
        nearer = stored(nearer, "labels")
        roots = nearer.groupBy("label").agg(F.count("*").alias("n"))
        roots = roots.join(nearer.select(F.col("node").alias("label"), F.col("label").alias("root")), "label")
        jumped = join_groups(nearer, stored(roots, "roots"), "label", "n", F.xxhash64("node"))
        labels = stored(jumped.select("node", "degree", F.col("root").alias("component"), "old"), "labels")
        changed = labels.where("component != old").limit(1).count()
        labels = labels.drop("old")
        if not changed:
            return labels.select("node", "component")
