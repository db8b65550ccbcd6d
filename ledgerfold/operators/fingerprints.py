"""Order-free fingerprints of bags of rows: two bags with equal ones hold equal rows.

A count alone does not see that rows were changed or exchanged. Beside it stand the
exclusive or of one 64-bit hash over all columns and the sum of another; both are
independent of order, see nulls, and tell how often a row occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.columns import named, sortable
from ledgerfold.spec import DEFAULT, ScdSpec

PARTS = ("n", "bits", "total")


def fingerprint(df: DataFrame, when: Column | None = None) -> list[Column]:
    """Aggregates ``n``, ``bits`` and ``total`` over the rows (those for which ``when`` holds)."""
    columns = [sortable(df.schema[c]) for c in sorted(df.columns)]
    # a null is skipped by the hash, so its place goes in as well
    nulls = F.concat(*[c.isNull().cast("string") for c in columns])
    one, two = F.xxhash64(*columns, nulls), F.xxhash64(nulls, *columns[::-1], F.lit("second"))
    if when is not None:
        one, two = F.when(when, one), F.when(when, two)
    total = F.sum(two.cast("decimal(20,0)"))
    return [
        F.count(one).alias("n"),
        F.coalesce(F.bit_xor(one), F.lit(0).cast("bigint")).alias("bits"),
        F.coalesce(total, F.lit(0)).cast("decimal(38,0)").alias("total"),
    ]


def fingerprint_by_month(df: DataFrame, spec: ScdSpec = DEFAULT) -> DataFrame:
    """The fingerprint of every month of a replica; one pass, and a row a month leaves each task."""
    return df.groupBy(*[named(c) for c in spec.partitioning]).agg(*fingerprint(df))


def differing_months(left: DataFrame, right: DataFrame, spec: ScdSpec = DEFAULT) -> DataFrame:
    """Months in which two replicas do not hold the same bag of rows, with both counts."""
    marks = {"left": F.lit(1), "right": F.lit(-1)}
    sides = [
        fingerprint_by_month(side, spec).select(
            *[named(c) for c in spec.partitioning],
            F.col("n").alias("n_left") if name == "left" else F.lit(0).cast("bigint").alias("n_left"),
            F.col("n").alias("n_right") if name == "right" else F.lit(0).cast("bigint").alias("n_right"),
            "bits",
            (F.col("total") * marks[name]).cast("decimal(38,0)").alias("total"),
        )
        for name, side in (("left", left), ("right", right))
    ]
    both = sides[0].unionByName(sides[1]).groupBy(*[named(c) for c in spec.partitioning])
    sums = both.agg(
        F.sum("n_left").alias("n_left"),
        F.sum("n_right").alias("n_right"),
        F.bit_xor("bits").alias("bits"),
        F.sum("total").alias("total"),
    )
    differs = (F.col("n_left") != F.col("n_right")) | (F.col("bits") != 0) | (F.col("total") != 0)
    return sums.filter(differs).select(*[named(c) for c in spec.partitioning], "n_left", "n_right")
