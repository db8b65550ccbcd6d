"""Reconciliation of a merged replica by open and closed row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.columns import (
    in_closed_partition,
    in_open_partition,
    is_closed_date,
    month_of,
    named,
)
from ledgerfold.spec import DEFAULT, ScdSpec


def new_entities(
    increment: DataFrame, base: DataFrame, spec: ScdSpec = DEFAULT, dense_ids: bool = False
) -> DataFrame:
    """Increment rows of entities the base replica does not know.

    With ``dense_ids`` the keys of the base are 1..count, and any key above the
    count is new; otherwise the keys themselves are compared.
    """
    if dense_ids:
        known = base.agg(F.count(F.lit(1))).scalar()
        return increment.filter(named(spec.key) > known)
    # one row per key and start month is enough, however often a key occurs;
    # the join then shuffles by key alone and may split frequent ones
    keys = base.select(named(spec.key), month_of(spec.eff_from).alias("__month")).distinct()
    return increment.join(keys.select(named(spec.key)), spec.key, "left_anti").select(
        *[named(c) for c in increment.columns]
    )


def _known_keys(base: DataFrame, spec: ScdSpec) -> DataFrame:
    return base.select(named(spec.key)).distinct()


def reconcile(
    base: DataFrame,
    increment: DataFrame,
    result: DataFrame,
    spec: ScdSpec = DEFAULT,
    dense_ids: bool = False,
) -> DataFrame:
    """Expected and actual counts after the first merge on a fresh base.

    Open rows: those of the base and one for each new entity row. Closed rows:
    those of the increment. The counts see neither keys nor payload. Base, increment
    and result are counted in one pass each; without ``dense_ids`` the keys of the
    base are read beside that.
    """
    if dense_ids:
        marked = increment.withColumn(
            "__new", named(spec.key) > base.agg(F.count(F.lit(1))).scalar()
        )
    else:
        known = _known_keys(base, spec).withColumn("__known", F.lit(True))
        marked = increment.join(known, spec.key, "left").withColumn(
            "__new", F.col("__known").isNull()
        )
    of_result = _counts(
        result,
        open_actual=F.count_if(in_open_partition(spec)),
        closed_actual=F.count_if(in_closed_partition(spec)),
    )
    return _report(_counts(base, open_expected=F.count(F.lit(1))), marked, of_result, spec)


def reconcile_counts(
    base: DataFrame,
    increment: DataFrame,
    result: DataFrame,
    spec: ScdSpec = DEFAULT,
    keys: DataFrame | None = None,
) -> DataFrame:
    """The same report from rows counted by month (``footer_counts``) of base and result.

    ``keys`` holds the base's entities; without it they are 1..count, and nothing but the
    increment is read.
    """

    def rows(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))

    if keys is None:
        known = base.agg(rows(F.lit(True))).scalar()
        marked = increment.withColumn("__new", named(spec.key) > known)
    else:
        held = _known_keys(keys, spec).withColumn("__known", F.lit(True))
        marked = increment.join(held, spec.key, "left").withColumn("__new", F.col("__known").isNull())
    of_result = _counts(
        result, open_actual=rows(in_open_partition(spec)), closed_actual=rows(in_closed_partition(spec))
    )
    return _report(_counts(base, open_expected=rows(F.lit(True))), marked, of_result, spec)


def _report(of_base: DataFrame, marked: DataFrame, of_result: DataFrame, spec: ScdSpec) -> DataFrame:
    of_increment = _counts(
        marked,
        open_expected=F.count_if("__new"),
        closed_expected=F.count_if(is_closed_date(spec)),
    )
    all_counts = of_base.unionByName(of_increment).unionByName(of_result)
    counts = all_counts.agg(*[F.sum(c).alias(c) for c in _SIDES])
    checks = [
        F.struct(
            F.col(f"{kind}_expected").alias("expected"),
            F.col(f"{kind}_actual").alias("actual"),
            F.lit(kind).alias("check"),
        )
        for kind in ("open", "closed")
    ]
    report = counts.select(F.inline(F.array(*checks)))
    return report.select(
        "check", "expected", "actual", (F.col("expected") == F.col("actual")).alias("ok")
    )


_SIDES = ("open_expected", "closed_expected", "open_actual", "closed_actual")


def _counts(df: DataFrame, **counts: Column) -> DataFrame:
    """One row with the given counts, and nothing for the other sides."""
    zero = F.lit(0).cast("bigint")
    return df.agg(*[c.alias(side) for side, c in counts.items()]).select(
        *[F.col(s) if s in counts else zero.alias(s) for s in _SIDES]
    )
