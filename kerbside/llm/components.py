"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .durable import durable


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); a component is named by its smallest node.

    Each round every node takes the smallest name among its neighbours, then that name's own name, until none changes: the
    number of rounds grows with the logarithm of a component's width. Minima are combined before the shuffle, so a node with
    many neighbours burdens no task.
    """
    edges = durable(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b").distinct())
    names = durable(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")))
    while True:
        near = edges.join(names, edges["b"] == names["node"]).groupBy("a").agg(F.min("component").alias("near"))
        lower = names.join(near, names["node"] == near["a"]).select("node", F.col("component").alias("old"), F.least("component", "near").alias("hop"))
        above = names.select(F.col("node").alias("hop"), F.col("component").alias("above"))
        names = durable(lower.join(above, "hop").select("node", F.least("hop", "above").alias("component"), "old"))
        if not names.where("component <> old").limit(1).count():
            return names.select("node", "component")
        names = names.select("node", "component")
