"""Version rank per entity, newest first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.functions.columns import is_open_date, named, payload_order
from ledgerfold.session import checkpointed
from ledgerfold.spec import DEFAULT, ScdSpec

ORIGIN = "__origin"
FROM_INCREMENT, FROM_REPLICA = 0, 1
_BLOCK, _BEFORE, _COPY = "__block", "__before", "__copy"


def candidates(replica_open: DataFrame, increment: DataFrame) -> DataFrame:
    """Increment rows and open replica rows in one bag, marked by origin."""
    return increment.withColumn(ORIGIN, F.lit(FROM_INCREMENT)).unionByName(
        replica_open.withColumn(ORIGIN, F.lit(FROM_REPLICA))
    )


def version_order(df: DataFrame, spec: ScdSpec) -> list[Column]:
    """Newest start, then latest end; ties: increment row, then the payload."""
    order = [named(spec.eff_from).desc_nulls_last(), named(spec.eff_to).desc_nulls_last()]
    if ORIGIN in df.columns:
        order.append(F.col(ORIGIN).asc())
    return order + payload_order(df, spec, skip=(ORIGIN,))


def latest_open(df: DataFrame, spec: ScdSpec = DEFAULT) -> DataFrame:
    """The first-ranked version of every entity, where that version is open.

    ``rank = 1`` alone as the filter lets Spark keep one row per entity in each
    task before the shuffle, so an entity with very many versions costs no more
    there than one row per task.
    """
    newest = Window.partitionBy(named(spec.key)).orderBy(*version_order(df, spec))
    top = df.withColumn("__rn", F.row_number().over(newest)).filter(F.col("__rn") == 1)
    return top.drop("__rn").filter(is_open_date(spec))


def rank_versions(df: DataFrame, spec: ScdSpec = DEFAULT, name: str = "rn") -> DataFrame:
    """Number the versions of each entity, 1 for the newest.

    All rows are cut into ordered blocks by range of entity and version order, so an
    entity with very many versions lies in several: the rank is the place in the
    block plus the rows of the entity in earlier blocks. A running number as the
    last sort key lets even equal rows fall into different blocks. The blocks are
    checkpointed since both passes below must see the same ones.
    """
    key = named(spec.key)
    numbered = df.withColumn(_COPY, F.monotonically_increasing_id())
    order = [*version_order(df, spec), F.col(_COPY).asc()]
    blocks = checkpointed(
        numbered.repartitionByRange(key.asc_nulls_last(), *order).withColumn(
            _BLOCK, F.spark_partition_id()
        )
    )
    earlier = (
        Window.partitionBy("__key").orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    )
    # a row per entity and block it touches: ranges overlap at their ends only
    offsets = (
        blocks.groupBy(key.alias("__key"), F.col(_BLOCK).alias("__of"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumnRenamed("__of", _BLOCK)
        .withColumn(_BEFORE, F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .filter(F.col(_BEFORE) > 0)
        .select("__key", F.col(_BLOCK).alias("__of"), _BEFORE)
    )
    within = Window.partitionBy(key, _BLOCK).orderBy(*order)
    placed = blocks.withColumn("__place", F.row_number().over(within))
    # only entities that go on from an earlier block are on the right, two to a block at most
    same = key.eqNullSafe(F.col("__key")) & (F.col(_BLOCK) == F.col("__of"))
    rank = F.col("__place") + F.coalesce(F.col(_BEFORE), F.lit(0).cast("bigint"))
    return placed.join(offsets, same, "left").select(
        *[named(c) for c in df.columns], rank.alias(name)
    )
