"""Read and seed replicas held as month-partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerfold.functions.columns import named
from ledgerfold.sources.ledger import Ledger
from ledgerfold.sources.staging import write_replica
from ledgerfold.spec import DEFAULT, ScdSpec


def read_replica(
    spark: SparkSession, path: str, spec: ScdSpec = DEFAULT, schema: T.StructType | None = None
) -> DataFrame:
    """Scan a replica; the month columns are dates, whatever discovery makes of them."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    found = spark.read.parquet(path)
    casts = {
        c: named(c).cast("date")
        for c in spec.partitioning
        if found.schema[c].dataType != T.DateType()
    }
    return found.withColumns(casts) if casts else found


def read_increment(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Scan an increment as its source wrote it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def seed(spark: SparkSession, source: str, target: str, spec: ScdSpec = DEFAULT) -> DataFrame:
    """Copy a pristine replica over ``target`` and scan the copy.

    Its files lie by month already, so the copy needs no shuffle. Refuses while a run on the
    target is unfinished; the target's records begin anew, its claims count on.
    """
    pristine, ledger = read_replica(spark, source, spec), Ledger(spark, target)
    ledger.free()
    number = ledger.last()
    write_replica(pristine, target, "overwrite", spec)
    if number:
        ledger.begin_again(number + 1)
    return read_replica(spark, target, spec, pristine.schema)
