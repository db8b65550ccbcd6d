"""Row operators: derive months, conform an increment, pick slices and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.functions.columns import (
    ends_before_open_month,
    in_closed_partition,
    in_open_partition,
    month_of,
    named,
)
from ledgerfold.spec import DEFAULT, ScdSpec


def with_months(df: DataFrame, spec: ScdSpec = DEFAULT) -> DataFrame:
    """Add (or replace) the two month columns, as dates."""
    return df.withColumns(
        {spec.part_from: month_of(spec.eff_from), spec.part_to: month_of(spec.eff_to)}
    )


def _dated(df: DataFrame, spec: ScdSpec) -> DataFrame:
    """Turn the validity columns into dates; text that is no date becomes null.

    An instant has a date only in some time zone, so such a column is an error:
    the day would follow the session's zone.
    """
    casts = {}
    for name in (spec.eff_from, spec.eff_to):
        kind = df.schema[name].dataType
        if isinstance(kind, T.TimestampType):
            raise ValueError(f"{name} is an instant; give its date in the zone it is meant for")
        if kind != T.DateType():
            casts[name] = named(name).try_cast("date")
    return df.withColumns(casts) if casts else df


def conform(increment: DataFrame, replica: DataFrame, spec: ScdSpec = DEFAULT) -> DataFrame:
    """Shape an increment like the replica: its columns, order and types.

    Months are derived from the dates, extra columns go, and a column the
    increment lacks is an error.
    """
    needed = [c for c in replica.columns if c not in spec.partitioning]
    given = {c.lower() for c in increment.columns}
    missing = [c for c in needed if c.lower() not in given]
    if missing:
        raise ValueError(f"increment lacks replica columns: {', '.join(missing)}")
    renamed = increment.select(*[named(c).alias(c) for c in needed])
    dated = with_months(_dated(renamed, spec), spec)
    typed = [
        named(f.name)
        if dated.schema[f.name].dataType == f.dataType
        else named(f.name).cast(f.dataType).alias(f.name)
        for f in replica.schema.fields
    ]
    return dated.select(*typed)


def usable_dates(increment: DataFrame, spec: ScdSpec = DEFAULT) -> Column:
    """Whether both validity columns hold a date."""
    dates = [named(c).try_cast("date") for c in (spec.eff_from, spec.eff_to)]
    return dates[0].isNotNull() & dates[1].isNotNull()


def split_rejects(increment: DataFrame, spec: ScdSpec = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Opt-in guard: rows with two usable dates, and the rows without."""
    usable = usable_dates(increment, spec)
    return increment.filter(usable), increment.filter(~usable)


def open_slice(replica: DataFrame, spec: ScdSpec = DEFAULT) -> DataFrame:
    """Rows of the open partition; a partition filter on a replica scan."""
    return replica.filter(in_open_partition(spec))


def closed_slice(replica: DataFrame, spec: ScdSpec = DEFAULT) -> DataFrame:
    """Rows of all closed partitions."""
    return replica.filter(in_closed_partition(spec))


def open_subpartitions(replica: DataFrame, spec: ScdSpec = DEFAULT) -> DataFrame:
    """Start months that have open rows, in order."""
    months = open_slice(replica, spec).select(named(spec.part_from)).distinct()
    return months.orderBy(F.col(spec.part_from))


def closed_keys(increment: DataFrame, spec: ScdSpec = DEFAULT) -> DataFrame:
    """Version keys the increment closes, one row per closing row."""
    return increment.filter(ends_before_open_month(spec)).select(
        named(spec.key), month_of(spec.eff_from).alias(spec.part_from), named(spec.eff_from)
    )
