"""The two merge strategies.

``changes_*`` give what a run has to write: the increment and the open slice as
it is afterwards. ``merge_*`` add the replica rows that stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.columns import is_closed_date, named, outside_open_partition
from ledgerfold.operators.rank import ORIGIN, candidates, latest_open
from ledgerfold.operators.slices import closed_keys, conform, open_slice
from ledgerfold.spec import DEFAULT, ScdSpec

def unclosed(open_rows: DataFrame, closed: DataFrame, spec: ScdSpec = DEFAULT) -> DataFrame:
    """Open rows whose version is not among the closed keys.

    The keys are made distinct together with their month, before the shuffle
    and again behind it. The join shuffles them anew by version, which leaves
    both of its inputs plain shuffles that adaptive execution may broadcast or
    split where one version (or the null key) is very frequent.
    """
    version = [spec.key, spec.eff_from]
    keys = closed.distinct().select(*[named(c) for c in version])
    kept = open_rows.join(keys, version, "left_anti")
    return kept.select(*[named(c) for c in open_rows.columns])


def touched_months(closed: DataFrame, spec: ScdSpec = DEFAULT) -> DataFrame:
    """Start months of the closed keys, which the calendar bounds; none for a key without start."""
    month = named(spec.part_from)
    return closed.select(month).filter(month.isNotNull()).distinct()


def changes_closed_key(
    replica: DataFrame, increment: DataFrame, spec: ScdSpec = DEFAULT
) -> DataFrame:
    """The increment, and the open versions it does not close."""
    new = conform(increment, replica, spec)
    return new.unionByName(unclosed(open_slice(replica, spec), closed_keys(new, spec), spec))


def changes_closed_key_by_subpartition(
    replica: DataFrame, increment: DataFrame, spec: ScdSpec = DEFAULT
) -> DataFrame:
    """Same rows, but only the sub-partitions with closed keys enter the join.

    The start months of the closed keys prune the partitions that are joined by
    version; open rows of all other months pass without a shuffle.
    """
    new = conform(increment, replica, spec)
    closed, rows = closed_keys(new, spec), open_slice(replica, spec)
    months = F.broadcast(touched_months(closed, spec))
    inside = rows.join(months, spec.part_from, "left_semi").select(*[named(c) for c in rows.columns])
    outside = rows.join(months, spec.part_from, "left_anti").select(*[named(c) for c in rows.columns])
    return new.unionByName(outside).unionByName(unclosed(inside, closed, spec))


def changes_latest(replica: DataFrame, increment: DataFrame, spec: ScdSpec = DEFAULT) -> DataFrame:
    """All closed candidates, and per entity its newest version where that is open."""
    bag = candidates(open_slice(replica, spec), conform(increment, replica, spec))
    return bag.filter(is_closed_date(spec)).unionByName(latest_open(bag, spec)).drop(ORIGIN)


def merge_closed_key(
    replica: DataFrame, increment: DataFrame, spec: ScdSpec = DEFAULT
) -> DataFrame:
    return _with_untouched(replica, changes_closed_key(replica, increment, spec), spec)


def merge_closed_key_by_subpartition(
    replica: DataFrame, increment: DataFrame, spec: ScdSpec = DEFAULT
) -> DataFrame:
    changes = changes_closed_key_by_subpartition(replica, increment, spec)
    return _with_untouched(replica, changes, spec)


def merge_latest(replica: DataFrame, increment: DataFrame, spec: ScdSpec = DEFAULT) -> DataFrame:
    return _with_untouched(replica, changes_latest(replica, increment, spec), spec)


def _with_untouched(replica: DataFrame, changes: DataFrame, spec: ScdSpec) -> DataFrame:
    return replica.filter(outside_open_partition(spec)).unionByName(changes)
