"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.staging import Scratch


def connected_components(links: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """``id, component`` for every end of a link; ``component`` is the smallest id reachable.

    ``links`` has the bigint columns ``a`` and ``b``; direction, repetition and order do
    not matter. Each round takes the smallest label around a node and then the label of
    that label, so long chains shorten by half. Every round is a written table: the
    lineage stays short and a lost executor costs one round. Without links the result is
    empty. Nodes are compared by joins and sums over keys; a hub is spread by partial
    aggregation.
    """
    both = scratch.stage(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "edges"
    )
    labels = scratch.stage(both.groupBy(F.col("a").alias("id")).agg(F.least("a", F.min("b")).alias("component")), "labels")
    for _ in range(max_rounds):
        around = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("around"))
        )
        lowered = labels.join(around, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "around").alias("near")
        )
        above = labels.select(F.col("id").alias("near"), F.col("component").alias("far"))
        step = scratch.stage(
            lowered.join(above, "near", "left").select(
                "id", F.coalesce(F.least("near", "far"), "near").alias("component"), "old"
            ),
            "labels",
        )
        labels = step.select("id", "component")
        if step.where("component <> old").isEmpty():
            return labels
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
