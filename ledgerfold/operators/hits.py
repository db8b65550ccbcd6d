"""Which stored open rows a run replaces, found by their addresses.

An address is the file of a row and its place in it. Keys, dates and addresses are
joined and ranked; no payload is shuffled for that. Only files with a hit are written anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.functions.columns import is_closed_date, is_open_date, named, payload_order
from ledgerfold.operators.merge import touched_months
from ledgerfold.operators.rank import FROM_INCREMENT, FROM_REPLICA, ORIGIN
from ledgerfold.spec import ScdSpec

FILE, ROW = "__file", "__row"
ADDRESS = (FILE, ROW)


def addressed(stored: DataFrame) -> DataFrame:
    """Rows of a Parquet scan with their addresses; a frame without files has no rows to place."""
    if not stored.inputFiles():
        return stored.withColumns({FILE: F.lit(""), ROW: F.lit(0).cast("bigint")})
    return stored.withColumns({FILE: F.col("_metadata.file_path"), ROW: F.col("_metadata.row_index")})


def closed_hits(placed: DataFrame, closed: DataFrame, spec: ScdSpec) -> DataFrame:
    """Addresses of the open rows whose version is closed; other start months are not read."""
    months = F.broadcast(touched_months(closed, spec))
    version = [spec.key, spec.eff_from]
    narrow = placed.select(*[named(c) for c in version], named(spec.part_from), *ADDRESS)
    keys = closed.distinct().select(*[named(c) for c in version])
    inside = narrow.join(months, spec.part_from, "left_semi")
    return inside.join(keys, version, "left_semi").select(*ADDRESS)


def _newest(spec: ScdSpec, extra: tuple[Column, ...] = ()) -> Window:
    order = [named(spec.eff_from).desc_nulls_last(), named(spec.eff_to).desc_nulls_last()]
    return Window.partitionBy(named(spec.key)).orderBy(*order, F.col(ORIGIN).asc(), *extra)


def _narrow(rows: DataFrame, origin: int, spec: ScdSpec) -> DataFrame:
    keys = [named(c) for c in (spec.key, spec.eff_from, spec.eff_to)]
    return rows.select(*keys, F.lit(origin).alias(ORIGIN), *ADDRESS)


def best_versions(
    placed: DataFrame, new: DataFrame, contested: DataFrame, spec: ScdSpec
) -> DataFrame:
    """Origin and address of the best versions of each contested entity, and how many tie.

    ``placed`` and ``new`` carry addresses. The rank goes by dates and origin alone, and its
    one filter lets Spark keep the best rows of a task before the shuffle.
    """
    same = named(spec.key).eqNullSafe(F.col("__key"))
    rivals = _narrow(placed, FROM_REPLICA, spec).join(contested, same, "left_semi")
    bag = rivals.unionByName(_narrow(new, FROM_INCREMENT, spec))
    best = bag.withColumn("__rn", F.rank().over(_newest(spec))).filter(F.col("__rn") == 1)
    tied = F.count(F.lit(1)).over(Window.partitionBy(named(spec.key)))
    return best.withColumn("__n", tied).select(ORIGIN, *ADDRESS, "__n")


def newest(
    best: DataFrame, equal: DataFrame, placed: DataFrame, new: DataFrame, spec: ScdSpec
) -> DataFrame:
    """Origin and address of the first-ranked versions.

    Only the ``equal`` ones of the best, alike in dates and origin, are looked up in full, to
    be told apart by their payload.
    """
    alone = best.filter("__n = 1").drop("__n")
    if equal.isEmpty():
        return alone
    full = _marked(placed, FROM_REPLICA).unionByName(_marked(new, FROM_INCREMENT))
    rows = full.join(equal, [ORIGIN, *ADDRESS], "left_semi")
    by_payload = [*payload_order(rows, spec, skip=(ORIGIN, *ADDRESS)), F.col(FILE), F.col(ROW)]
    first = F.row_number().over(_newest(spec, tuple(by_payload)))
    chosen = rows.withColumn("__rn", first).filter(F.col("__rn") == 1)
    return alone.unionByName(chosen.select(ORIGIN, *ADDRESS))


def _marked(rows: DataFrame, origin: int) -> DataFrame:
    return rows.withColumn(ORIGIN, F.lit(origin))


def latest_hits(
    placed: DataFrame, contested: DataFrame, winners: DataFrame, spec: ScdSpec
) -> DataFrame:
    """Addresses of stored open versions that are not the newest of their entity."""
    same = named(spec.key).eqNullSafe(F.col("__key"))
    rivals = _narrow(placed.filter(is_open_date(spec)), FROM_REPLICA, spec)
    kept = winners.filter(F.col(ORIGIN) == FROM_REPLICA).select(*ADDRESS)
    return rivals.join(contested, same, "left_semi").select(*ADDRESS).join(kept, list(ADDRESS), "left_anti")


def latest_new(new: DataFrame, winners: DataFrame, spec: ScdSpec) -> DataFrame:
    """Increment rows that enter: closed ones, and open ones that are the newest of their entity."""
    columns = [named(c) for c in new.columns if c not in ADDRESS]
    won = winners.filter(F.col(ORIGIN) == FROM_INCREMENT).select(*ADDRESS)
    opened = new.filter(is_open_date(spec)).join(won, list(ADDRESS), "left_semi")
    return new.filter(is_closed_date(spec)).select(*columns).unionByName(opened.select(*columns))


def surviving(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Rows of some files without the hits."""
    kept = addressed(rows).join(hits, list(ADDRESS), "left_anti")
    return kept.select(*[named(c) for c in rows.columns])
