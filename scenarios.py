"""Replicas and increments made from the whole ``orders`` and ``lineitem`` tables.

Which rows change follows from their business columns: each status and priority
(or flag) stands for one kind of change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.operators.slices import with_months
from ledgerfold.spec import DEFAULT

ORDER = ("id", "status", "amount", "eff_from_dt", "eff_to_dt")
LINE = ("id", "line", "quantity", "price", "flag", "eff_from_dt", "eff_to_dt")


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def _changes(
    rows: DataFrame, columns: tuple[str, ...], kinds: list[tuple[Column, dict[str, Column]]]
) -> DataFrame:
    """For every kind of change, the rows it applies to with its new values; one scan."""
    made = [
        F.when(test, F.struct(*[new.get(c, F.col(c)).alias(c) for c in columns]))
        for test, new in kinds
    ]
    applying = F.filter(F.array(*made), lambda change: change.isNotNull())
    return rows.select(F.inline(applying))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").cast("date").alias("eff_from_dt"),
        F.lit(DEFAULT.open_date).alias("eff_to_dt"),
        F.col("o_orderpriority").alias("priority"),
    )


def orders_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One open version per order."""
    return with_months(_orders(spark, sf_dir).select(*ORDER))


def orders_increment(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    """Changed orders, without the month columns.

    Clean: urgent ``O`` orders are closed and succeeded, high ``P`` orders bring
    new entities. Dirty adds orders only closed, orders only succeeded, late
    rows of an older start, and plain re-deliveries.
    """
    orders = _orders(spark, sf_dir)
    orders = orders.withColumn("known", orders.agg(F.count(F.lit(1))).scalar())

    def of(status: str, priority: str) -> Column:
        return (F.col("status") == status) & (F.col("priority") == priority)

    closing = {"eff_to_dt": _day("2005-05-31")}
    successor = {
        "status": F.lit("U"),
        "amount": F.col("amount") + 1,
        "eff_from_dt": _day("2005-06-01"),
    }
    entity = {
        "id": F.col("id") + F.col("known") + 1,
        "status": F.lit("N"),
        "eff_from_dt": _day("2005-06-02"),
    }
    late = {"status": F.lit("L"), "eff_from_dt": _day("1990-01-15")}
    kinds = [
        (of("O", "1-URGENT"), closing),
        (of("O", "1-URGENT"), successor),
        (of("P", "2-HIGH"), entity),
    ]
    if dirty:
        kinds += [
            (of("F", "5-LOW"), closing),
            (of("P", "3-MEDIUM"), successor),
            (of("O", "5-LOW"), late),
            (of("F", "1-URGENT"), {}),
        ]
    return _changes(orders, ORDER, kinds)


def keyed_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean increment by remainder of the key: a tenth of the orders closed and succeeded,
    a twentieth as many rows of new entities."""
    orders = _orders(spark, sf_dir)
    orders = orders.withColumn("known", orders.agg(F.count(F.lit(1))).scalar())
    successor = {
        "status": F.lit("U"),
        "amount": F.col("amount") + 1,
        "eff_from_dt": _day("2005-06-01"),
    }
    entity = {
        "id": F.col("id") + F.col("known"),
        "status": F.lit("N"),
        "eff_from_dt": _day("2005-06-02"),
    }
    kinds = [
        (F.col("id") % 10 == 0, {"eff_to_dt": _day("2005-05-31")}),
        (F.col("id") % 10 == 0, successor),
        (F.col("id") % 20 == 7, entity),
    ]
    return _changes(orders, ORDER, kinds)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_shipdate").cast("date").alias("eff_from_dt"),
        F.lit(DEFAULT.open_date).alias("eff_to_dt"),
        F.col("l_linestatus").alias("linestatus"),
    )


def lines_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as an open version of its order: several per entity."""
    return with_months(_lines(spark, sf_dir).select(*LINE))


def lines_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines are closed and succeeded, accepted ones only closed,
    undecided open ones come again."""

    def of(flag: str, status: str) -> Column:
        return (F.col("flag") == flag) & (F.col("linestatus") == status)

    kinds = [
        (of("R", "F"), {"eff_to_dt": _day("2002-01-31")}),
        (of("R", "F"), {"flag": F.lit("X"), "eff_from_dt": _day("2002-02-01")}),
        (of("A", "F"), {"eff_to_dt": _day("2001-12-15")}),
        (of("N", "O"), {}),
    ]
    return _changes(_lines(spark, sf_dir), LINE, kinds)


def with_text_dates(df: DataFrame) -> DataFrame:
    """Dates as text, which any engine shows alike."""
    dates = [f.name for f in df.schema.fields if f.dataType.simpleString() == "date"]
    return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df
