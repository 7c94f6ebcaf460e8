"""Connected components of a table of links, as DataFrame joins (nothing reaches the driver but a count)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoprice.llm.common import materialise


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; a component is named by its smallest node.

    Each round takes the least label among a node and its neighbours, then the label of that label
    (pointer jumping), so the rounds grow with the logarithm of the longest path. Neighbour minima are
    combined map-side: a node with very many links is no hot group. Rounds are written tables.
    """
    both = materialise(links.select(F.col(a).alias("src"), F.col(b).alias("dst"))
                       .union(links.select(F.col(b), F.col(a))).distinct(), "links")
    labels = materialise(both.groupBy("src").agg(F.min("dst").alias("near"))
                         .select(F.col("src").alias("node"), F.least("src", "near").alias("component")), "labels")
    while True:
        around = (both.join(labels.withColumnRenamed("node", "dst"), "dst")
                  .groupBy(F.col("src").alias("node")).agg(F.min("component").alias("near")))
        least = labels.join(around, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("jump"))
        step = materialise(least.join(up, "component", "left").select(
            "node", "old", F.least("component", F.coalesce("jump", "component")).alias("component")), "labels")
        if step.where("old <> component").isEmpty():
            return step.select("node", "component")
        labels = step.select("node", "component")
