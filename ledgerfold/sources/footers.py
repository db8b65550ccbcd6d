"""Rows of a stored replica by month, from the footers of its files.

Spark's second Parquet reader answers counts grouped by partition from footers, so no
column and no row is read. A session of its own has it switched on; the caller's keeps
its settings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.functions.columns import named
from ledgerfold.sources.files import Folder
from ledgerfold.spec import DEFAULT, ScdSpec

# Formats that stay with the first reader: all but Parquet.
_FIRST_READER = "avro,csv,json,kafka,orc,text"


def _counting(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings that counts from footers."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.sources.useV1SourceList", _FIRST_READER)
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def counted_by_footers(
    spark: SparkSession, location: str, names: list[str] | None = None, spec: ScdSpec = DEFAULT
) -> DataFrame:
    """``n`` rows for each month of a replica, or of some files below it; months as text.

    A frame of the counting session, to be collected. The months bound its rows.
    """
    months = T.StructType([T.StructField(c, T.DateType()) for c in spec.partitioning])
    reader = _counting(spark).read.schema(months).option("basePath", location)
    paths = [location] if names is None else [f"{location}/{n}" for n in names]
    counts = reader.parquet(*paths).groupBy(*[named(c) for c in spec.partitioning]).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.select(
        named(spec.part_to).cast("string").alias("ends"),
        named(spec.part_from).cast("string").alias("starts"),
        "n",
    )


def month_counts(
    spark: SparkSession, location: str, names: list[str] | None = None, spec: ScdSpec = DEFAULT
) -> dict[tuple[str | None, str | None], int]:
    """The same on the driver; the calendar bounds the months."""
    if names == []:
        return {}
    return {(r.ends, r.starts): r.n for r in counted_by_footers(spark, location, names, spec).collect()}


def footer_counts(spark: SparkSession, path: str, spec: ScdSpec = DEFAULT) -> DataFrame:
    """``n`` rows for each month of the replica at ``path``; no column of it is read."""
    found = month_counts(spark, path.rstrip("/"), None, spec) if _has_months(spark, path) else {}
    rows = [(ends, starts, n) for (ends, starts), n in found.items()]
    made = spark.createDataFrame(rows, "ends string, starts string, n bigint")
    return made.select(
        F.col("ends").cast("date").alias(spec.part_to),
        F.col("starts").cast("date").alias(spec.part_from),
        "n",
    )


def _has_months(spark: SparkSession, path: str) -> bool:
    return any("=" in name for name in Folder(spark, path).names())
