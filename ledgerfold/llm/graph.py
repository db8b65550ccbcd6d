"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.session import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node it reaches), for nodes that have an edge.

    ``edges`` has columns ``a`` and ``b`` of one type that can be ordered. In every
    round a node takes the smallest label around it and then that node's own label,
    so labels travel twice as far each round.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = checkpointed(both.filter("a != b").distinct())
    labels = checkpointed(
        around.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("label")
        )
    )
    while True:
        near = (
            around.join(labels.withColumnsRenamed({"node": "b", "label": "near"}), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("near").alias("near"))
        )
        nearest = labels.join(near, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("next")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        after = checkpointed(
            nearest.join(jump, "next").select("node", "before", F.least("next", "beyond").alias("label"))
        )
        moved = after.filter(F.col("label") != F.col("before")).limit(1).count()
        labels = after.select("node", "label")
        if not moved:
            return labels
