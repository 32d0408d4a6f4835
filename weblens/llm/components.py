"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblens.shared import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """`(node, label)` of every node of `links(x, y)`: the smallest node it can reach.

    Each round takes the smallest label among a node's neighbours and then the label of
    that label, so labels travel twice as far each time. Rounds are written tables; only
    the count of changed labels comes to the driver.
    """
    edges = links.select("x", "y").where("x <> y")
    turned = edges.select(F.col("y").alias("x"), F.col("x").alias("y"))
    edges = cut_lineage(edges.unionByName(turned).distinct())
    labels = edges.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("label"))
    labels = cut_lineage(labels.select("node", F.least("node", "label").alias("label")))
    while True:
        near = (
            edges.join(labels, edges["y"] == labels["node"])
            .groupBy(F.col("x").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        nearer = labels.join(near, "node").select(
            "node", F.least("label", "near").alias("nearer"), "label"
        )
        onward = labels.select(F.col("node").alias("nearer"), F.col("label").alias("far"))
        stepped = cut_lineage(
            nearer.join(onward, "nearer").select(
                "node", F.least("nearer", "far").alias("label"), F.col("label").alias("old")
            )
        )
        labels = stepped.select("node", "label")
        if stepped.where("label <> old").isEmpty():
            return labels
