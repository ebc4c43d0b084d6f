"""Connected components of a stored table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node of the links (a, b).

    Every round takes the least label among a node's neighbours and then the label of that label, so
    labels travel at doubling distance. Minima are combined before the shuffle, so a node may have any
    number of links.
    """
    both = materialise(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        )
        least = labels.join(near, F.col("node") == F.col("a")).select("node", "component", F.least("component", "near").alias("next"))
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("further"))
        moved = materialise(
            least.join(jump, F.col("next") == F.col("via"), "left")
            .select("node", F.least("next", "further").alias("component"), (F.least("next", "further") != F.col("component")).alias("moved")),
            "labels",
        )
        if not moved.agg(F.max("moved")).first()[0]:
            return moved.select("node", "component")
        labels = moved.select("node", "component")
