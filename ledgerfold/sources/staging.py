"""Stage the rows of a run and publish them to the replica."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.functions.columns import in_open_partition, named
from ledgerfold.sources.files import Folder
from ledgerfold.spec import DEFAULT, ScdSpec


def by_month(df: DataFrame, spec: ScdSpec = DEFAULT) -> DataFrame:
    """Bring the rows of a month together, in tasks of even size.

    A rebalance splits the large months over many tasks, which a plain
    repartition by month cannot do.
    """
    return df.hint("rebalance", *[named(c) for c in spec.partitioning])


def _write(
    df: DataFrame, path: str, mode: str, columns: tuple[str, ...], overwrite: str = "static"
) -> None:
    writer = df.write.mode(mode).option("partitionOverwriteMode", overwrite)
    writer.option("compression", "zstd").partitionBy(*columns).parquet(path)


def write_replica(df: DataFrame, path: str, mode: str, spec: ScdSpec = DEFAULT) -> None:
    """Write rows to their months, as many files as tasks hold rows of a month."""
    _write(df, path, mode, spec.partitioning)


def stage(df: DataFrame, path: str, spec: ScdSpec = DEFAULT, rebalance: bool = True) -> None:
    """Write the rows of a run to a fresh path; an existing one is an error."""
    write_replica(by_month(df, spec) if rebalance else df, path, "errorifexists", spec)


def stage_more(df: DataFrame, path: str, spec: ScdSpec = DEFAULT) -> None:
    """Write further rows of a run beside those staged, as its tasks hold them."""
    write_replica(df, path, "append", spec)


def open_folder(replica_path: str, spec: ScdSpec) -> str:
    return f"{replica_path.rstrip('/')}/{spec.part_to}={spec.open_month}"


def replaced_rows(
    rows: DataFrame, spec: ScdSpec = DEFAULT, scope: DataFrame | None = None
) -> DataFrame:
    """Open rows, of the start months in ``scope`` where one is given: what a publish replaces."""
    opened = rows.filter(in_open_partition(spec))
    if scope is None:
        return opened
    # start months are bounded by the calendar
    return opened.join(F.broadcast(scope), spec.part_from, "left_semi").select(*rows.columns)


def added_rows(
    rows: DataFrame, spec: ScdSpec = DEFAULT, scope: DataFrame | None = None
) -> DataFrame:
    """The other rows: closed ones, those without an end, open ones outside ``scope``."""
    opened = F.coalesce(in_open_partition(spec), F.lit(False))
    if scope is None:
        return rows.filter(~opened)
    inside = scope.select(named(spec.part_from).alias("__month"))
    same = opened & (named(spec.part_from) == F.col("__month"))
    return rows.join(F.broadcast(inside), same, "left_anti")


def publish_open_slice(staged: DataFrame, replica_path: str, spec: ScdSpec = DEFAULT) -> None:
    """Replace the whole open slice of the replica by the staged open rows.

    The target is the open month's folder itself, so start months that have no
    rows any more go as well, and closed months are not touched.
    """
    rows = replaced_rows(staged, spec).drop(spec.part_to)
    _write(rows, open_folder(replica_path, spec), "overwrite", (spec.part_from,))


def months_of(scope: DataFrame, spec: ScdSpec) -> list[str]:
    """Start months as text; the calendar bounds them."""
    return [r[0] for r in scope.select(named(spec.part_from).cast("string")).distinct().collect()]


def emptied_months(staged_path: str, scope: DataFrame, spec: ScdSpec) -> list[str]:
    """Months of the scope in which no open row is staged."""
    kept = Folder(scope.sparkSession, open_folder(staged_path, spec)).names()
    return [m for m in months_of(scope, spec) if f"{spec.part_from}={m}" not in kept]


def publish_subpartitions(
    staged: DataFrame,
    staged_path: str,
    replica_path: str,
    scope: DataFrame,
    spec: ScdSpec = DEFAULT,
) -> None:
    """Replace the start months of the scope in the open slice by the staged open rows.

    Months that have rows are replaced in one dynamic overwrite; the folders of
    the others go.
    """
    folder = open_folder(replica_path, spec)
    rows = replaced_rows(staged, spec, scope).drop(spec.part_to)
    _write(rows, folder, "overwrite", (spec.part_from,), "dynamic")
    there = Folder(staged.sparkSession, folder)
    for month in emptied_months(staged_path, scope, spec):
        there.delete(f"{spec.part_from}={month}")


def append_rest(
    staged: DataFrame,
    replica_path: str,
    spec: ScdSpec = DEFAULT,
    scope: DataFrame | None = None,
) -> None:
    """Append the staged rows that replace nothing."""
    write_replica(added_rows(staged, spec, scope), replica_path, "append", spec)


def publish(staged: DataFrame, replica_path: str, spec: ScdSpec = DEFAULT) -> None:
    """Append the closed versions, then replace the open slice.

    Two writes, and plain Parquet has no transaction around them: staging must
    stay until both are done.
    """
    append_rest(staged, replica_path, spec)
    publish_open_slice(staged, replica_path, spec)


def drop_staging(spark: SparkSession, path: str) -> None:
    """Delete the staged rows of a published run."""
    Folder(spark, path).delete()


def staged_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/data/run_id={run_id}"


def notes_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/notes/run_id={run_id}"


def bind(spark: SparkSession, root: str, target: str) -> None:
    """Make the root that of one target; another's root is an error."""
    folder = Folder(spark, root)
    owner = folder.read("target.json")
    if not owner:
        folder.put("target.json", {"target": target})
    elif owner.get("target") != target:
        raise ValueError(f"{root} holds the staged rows of {owner.get('target')}, not of {target}")


def drop_staged(spark: SparkSession, root: str, keep: tuple[str | None, ...]) -> None:
    """Delete staged rows of all runs but ``keep``, and all notes."""
    folder = Folder(spark, root)
    folder.delete("notes")
    for name in folder.names("data"):
        if name.removeprefix("run_id=") not in keep:
            folder.delete(f"data/{name}")
