"""Connected components of a graph that is given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import settle


def components(links: DataFrame) -> DataFrame:
    """links has u and v; returns node, component (the smallest node reachable) for every node of a link.

    Each round gives a node the smallest label around it and then that label's own label, so paths halve;
    labels are written between rounds.
    """
    both = settle(
        links.select("u", "v").union(links.select("v", "u")).filter("u <> v").distinct()
    )
    labels = settle(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("component")))
    while True:
        around = (
            both.join(labels.withColumnRenamed("node", "v"), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(around, "node").select("node", F.least("component", "near").alias("component"), F.col("component").alias("was"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        new = settle(
            lower.join(jump, "component", "left").select(
                "node", F.least("component", F.coalesce("further", "component")).alias("component"), "was"
            )
        )
        labels = new.select("node", "component")
        if new.filter("component <> was").isEmpty():
            return labels
