"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stage


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` for every node of a link, ``component`` being the smallest node it is connected to.

    Each round takes the smallest label around a node, then the label of that label, until nothing changes: the number
    of rounds grows with the logarithm of the longest path. A node with very many links is only
    ever the frequent key of a join's larger side, which Spark splits, or of a minimum, which is combined before it moves.
    """
    edges = links.select(F.col(left).alias("u"), F.col(right).alias("v"))
    edges = stage(edges.union(edges.select("v", "u")).filter("u <> v").distinct(), "links")
    labels = stage(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        around = edges.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("component").alias("m"))
        nearer = labels.join(around, F.col("node") == F.col("u")).select("node", F.col("component").alias("old"), F.least("component", "m").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("component").alias("far"))
        moved = stage(nearer.join(jump, "near").select("node", "old", F.least("near", "far").alias("component")), "labels")
        labels = moved.select("node", "component")
        if moved.filter("component <> old").isEmpty():
            return labels
