"""Connected components of a graph given as an edge table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.session import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of (node, other); a component is named by its smallest node.

    In each round a node takes the smallest label among its own and its neighbours', and then
    the label of the node it points to, so chains shrink by halves. Hubs are joined, never
    gathered: a hub's edges may lie in many tasks. Rounds go on until nothing changes.
    """
    both = settle(edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other"))).where("node <> other").distinct(), "edges")
    labels = settle(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "component"), "other").groupBy("node").agg(F.min("component").alias("near"))
        nearer = labels.join(near, "node", "left").select("node", "component", F.least("component", F.coalesce("near", "component")).alias("next"))
        ahead = labels.select(F.col("node").alias("next"), F.col("component").alias("ahead"))
        moved = settle(
            nearer.join(ahead, "next", "left").select("node", F.least("next", F.coalesce("ahead", "next")).alias("component"), F.col("component").alias("was")), "labels")
        labels = moved.select("node", "component")
        if moved.where("component <> was").isEmpty():
            return labels
