"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm.common import saved


def connected_components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links(a, b)``; the label is the component's least node.

    Each round takes the least label among the neighbours and then the label of the
    label, so a chain shortens by half or more in a round. A round is written to the
    shared folder; minima are formed before the shuffle, so a node with many links is
    no bottleneck.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = both.unionAll(links.select("b", "a")).distinct()
    both = saved(spark, both, "links")
    labels = both.groupBy("node").agg(F.least("node", F.min("other")).alias("label"))
    labels = saved(spark, labels, "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other")
        near = near.groupBy("node").agg(F.min("label").alias("near"))
        moved = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = moved.join(jump, "label", "left").select(
            "node", "old", F.least("label", "next").alias("label")
        )
        moved = saved(spark, moved, "labels")
        labels = moved.select("node", "label")
        if moved.filter("old <> label").isEmpty():
            return labels
