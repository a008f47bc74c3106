"""Connected components of a link table, as DataFrame iterations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.session import cut_lineage


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); root is the smallest
    node of its component.

    Each step gives a node the smallest root among its neighbours and itself,
    then the root of that root. Labels live in the shared folder between the
    steps; the driver sees only the number of changes. Aggregations combine
    before their shuffle, so a node with very many links is no bottleneck.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = both.unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct()
    both = cut_lineage(both, "cc_edges")
    labels = cut_lineage(
        both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("root")), "cc_labels"
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "other"), "other")
            .groupBy("node")
            .agg(F.min("root").alias("near"))
        )
        step = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("far"))
        moved = step.join(jump, "next").select("node", "root", F.least("next", "far").alias("next"))
        moved = cut_lineage(moved, "cc_labels")
        labels = moved.select("node", F.col("next").alias("root"))
        if moved.where("next < root").isEmpty():
            return labels
