"""Bag difference that spreads a group of very many copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.columns import named


def difference(left: DataFrame, right: DataFrame, chunk: int = 1_000_000) -> DataFrame:
    """Rows of ``left`` without one copy for each equal row of ``right``.

    Copies are counted, not carried, through the shuffle. What is left of a
    group is dealt out in chunks, so no task has to emit a whole large group.
    """
    columns = [named(c) for c in left.columns]
    copies = left.withColumn("__n", F.lit(1)).unionByName(right.withColumn("__n", F.lit(-1)))
    over = copies.groupBy(*columns).agg(F.sum("__n").alias("__n")).filter(F.col("__n") > 0)
    first = F.explode(F.sequence(F.lit(0), F.col("__n") - 1, F.lit(chunk)))
    chunks = over.withColumn("__first", first).hint("rebalance")
    size = F.least(F.lit(chunk), F.col("__n") - F.col("__first"))
    return chunks.withColumn("__copy", F.explode(F.sequence(F.lit(1), size))).select(*columns)
