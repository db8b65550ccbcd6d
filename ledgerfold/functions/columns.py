"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.spec import ScdSpec


def named(name: str) -> Column:
    """The column called ``name``, also when the name holds a dot or a space."""
    return F.col("`" + name.replace("`", "``") + "`")


def month_of(name: str) -> Column:
    """Last day of the month of a date column: the partition value."""
    return F.last_day(named(name))


def in_open_partition(spec: ScdSpec) -> Column:
    return named(spec.part_to) == F.lit(spec.open_month)


def in_closed_partition(spec: ScdSpec) -> Column:
    return named(spec.part_to) != F.lit(spec.open_month)


def outside_open_partition(spec: ScdSpec) -> Column:
    """Every row the open slice leaves behind, rows without an end date too."""
    return ~named(spec.part_to).eqNullSafe(F.lit(spec.open_month))


def ends_before_open_month(spec: ScdSpec) -> Column:
    """``last_day(eff_to) <> open month`` as a range test on the bare date.

    Without the function call the test reaches the Parquet scan.
    """
    end = named(spec.eff_to)
    return (end < F.lit(spec.open_month_start)) | (end > F.lit(spec.open_month))


def is_open_date(spec: ScdSpec) -> Column:
    return named(spec.eff_to) == F.lit(spec.open_date)


def is_closed_date(spec: ScdSpec) -> Column:
    return named(spec.eff_to) != F.lit(spec.open_date)


def _unordered(kind: T.DataType) -> bool:
    """Whether a map or a variant is part of the type."""
    if isinstance(kind, T.StructType):
        return any(_unordered(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _unordered(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def sortable(field: T.StructField) -> Column:
    """The column in a form Spark can order; maps and variants have no order."""
    if _unordered(field.dataType):
        return F.to_json(F.struct(named(field.name)))
    return named(field.name)


def payload_order(df: DataFrame, spec: ScdSpec, skip: tuple[str, ...] = ()) -> list[Column]:
    """Ascending order over every column that is not a date, a month or the key."""
    known = {spec.key, spec.eff_from, spec.eff_to, *spec.partitioning, *skip}
    return [sortable(f).asc_nulls_last() for f in df.schema.fields if f.name not in known]
