"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """`node` and `label`, the smallest node that it reaches, for every node of links (a, b: long).

    Each round takes the smallest label of the neighbours and then the label of that label, so that chains
    halve. Rounds are written to the shared folder; it ends when nothing changes.
    """
    both = cut_lineage(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")))
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        roots = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        step = cut_lineage(
            step.join(roots, "next").select("node", F.col("label").alias("old"), F.least("next", "further").alias("label"))
        )
        moved = step.filter("label <> old").limit(1).count()
        labels = step.select("node", "label")
        if not moved:
            return labels
