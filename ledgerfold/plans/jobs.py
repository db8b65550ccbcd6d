"""The whole job: merge an increment into a replica on storage, finish a broken run, undo a run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import astuple
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.functions.columns import in_open_partition, named
from ledgerfold.operators import hits as by_address
from ledgerfold.operators.bins import FILE_BYTES, MOST_SMALL, dealt, month_name, packed
from ledgerfold.operators.fingerprints import PARTS, fingerprint
from ledgerfold.operators.merge import touched_months, unclosed
from ledgerfold.operators.slices import closed_keys, conform, usable_dates
from ledgerfold.sources.files import Folder
from ledgerfold.sources.footers import month_counts
from ledgerfold.sources.ledger import ABANDONED, FOLDER, PUBLISHED, UNDONE, Ledger, Run
from ledgerfold.sources.replica import read_increment
from ledgerfold.sources.staging import (
    bind,
    by_month,
    drop_staged,
    notes_path,
    stage,
    stage_more,
    staged_path,
)
from ledgerfold.sources.targets import (
    PathReplica,
    Target,
    files_below,
    open_name,
    read_files,
    short,
    sizes_below,
)
from ledgerfold.spec import DEFAULT, ScdSpec

CLOSED_KEY, BY_SUBPARTITION, LATEST = "closed_key", "closed_key_by_subpartition", "latest"
BY_FILE = "closed_key_by_file"
STRATEGIES = (CLOSED_KEY, BY_SUBPARTITION, BY_FILE, LATEST)
COMPACTION = "compaction"
# Bytes in memory of noted keys or addresses that are broadcast; more of them are shuffled.
SMALL = 10 << 20
# Bytes of staged files that are appended as they are scanned; more of them are rebalanced.
FEW = 8 << 20


class _Work:
    """One attempt at a run: where things are and which claim it holds."""

    def __init__(
        self, spark: SparkSession, target: Target, ledger: Ledger, number: int, run: Run, spec: ScdSpec
    ) -> None:
        self.spark, self.target, self.ledger = spark, target, ledger
        self.number, self.run, self.spec = number, run, spec
        self.staged_at = staged_path(run.root, run.run_id)
        self.notes = Folder(spark, notes_path(run.root, run.run_id))
        self.aside = f"{FOLDER}/undo/{run.run_id}"
        self.location = target.location(spark)
        # whether the open partitions are pointed at what the run stages
        self.swaps = target.attach and run.strategy != COMPACTION
        self._bytes: dict[str, int] = {}

    def noted(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows written and read again, so that their size is known; small ones are broadcast.

        The size is that in memory: names of files and keys take a hundredth of it on disk.
        Spark goes by the disk, so rows that are not small ask for a join by sort.
        """
        path, seen = f"{self.notes.path}/{name}", Observation()
        rows.observe(seen, _in_memory(rows).alias("bytes")).write.parquet(path)
        self._bytes[name] = int(seen.get["bytes"] or 0)
        read = self.spark.read.schema(rows.schema).parquet(path)
        return F.broadcast(read) if self.is_small(name) else read.hint("merge")

    def is_small(self, name: str) -> bool:
        return self._bytes[name] <= SMALL


def _in_memory(rows: DataFrame) -> Column:
    """Bytes of the rows in a hash table, which holds a key twice: fixed parts and texts."""
    fixed = F.count(F.lit(1)) * (64 + 16 * len(rows.columns))
    texts = [
        F.coalesce(F.sum(F.octet_length(named(f.name))), F.lit(0))
        for f in rows.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    return reduce(lambda total, text: total + 2 * text, texts, fixed)


def _laid_out(work: _Work, new: DataFrame, kept: DataFrame, joined: str, compact: bool) -> DataFrame:
    """Both sides together, brought together by month where a join has scattered them.

    Rows that pass a broadcast join stay in the tasks that scan them, which hold
    whole stretches of a month already.
    """
    if compact or not work.is_small(joined):
        return by_month(new.unionByName(kept), work.spec)
    return by_month(new, work.spec).unionByName(kept)


def _closed_key_changes(
    work: _Work, rows: DataFrame, new: DataFrame, strategy: str, compact: bool
) -> tuple[DataFrame, list[str]]:
    """What a closed-key run stages, and the files whose rows that replaces."""
    spec = work.spec
    closed = work.noted(closed_keys(new, spec).distinct(), "closed")
    if strategy == BY_FILE:
        hits = work.noted(by_address.closed_hits(by_address.addressed(rows), closed, spec), "hits")
        return _by_file(work, rows, new, hits, compact)
    files = [] if work.target.attach else [short(f) for f in rows.inputFiles()]
    if strategy == BY_SUBPARTITION:
        months = [r[0] for r in touched_months(closed, spec).select(F.col(spec.part_from).cast("string")).collect()]
        folders = {f"{spec.part_from}={m}" for m in months}
        files = [f for f in files if f.split("/")[1] in folders]
        rows = read_files(work.spark, work.location, rows.schema, files)
    return _laid_out(work, new, unclosed(rows, closed, spec), "closed", compact), files


def _latest_changes(
    work: _Work, rows: DataFrame, new: DataFrame, compact: bool
) -> tuple[DataFrame, list[str]]:
    """What a latest-version run stages: ranked by address, only files with losers written anew."""
    spec = work.spec
    contested = work.noted(_contested(rows, new, spec), "contested")
    placed = by_address.addressed(rows)
    best = work.noted(by_address.best_versions(placed, new, contested, spec), "best")
    equal = work.noted(best.filter("__n > 1").drop("__n"), "equal")
    winners = work.noted(by_address.newest(best, equal, placed, new, spec), "winners")
    hits = work.noted(by_address.latest_hits(placed, contested, winners, spec), "hits")
    return _by_file(work, rows, by_address.latest_new(new, winners, spec), hits, compact)


def _by_file(
    work: _Work, rows: DataFrame, new: DataFrame, hits: DataFrame, compact: bool
) -> tuple[DataFrame, list[str]]:
    """The new rows and those of hit files without the hits; an attaching table takes all files."""
    if work.target.attach:
        return _laid_out(work, new, by_address.surviving(rows, hits), "hits", compact), []
    if compact:
        files = [short(f) for f in rows.inputFiles()]
    else:
        # names of files, which the driver lists anyway when it reads the slice
        files = [short(r[0]) for r in hits.select(by_address.FILE).distinct().collect()]
    hit = read_files(work.spark, work.location, rows.schema, files)
    kept = by_address.surviving(hit, hits) if files else hit
    return _laid_out(work, new, kept, "hits", compact), files


def _contested(rows: DataFrame, new: DataFrame, spec: ScdSpec) -> DataFrame:
    """Entities with an increment row or several open rows.

    Any other open row is the latest of its entity already. The test shuffles keys alone.
    """
    key = named(spec.key).alias("__key")
    repeated = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    several = repeated.filter(F.col("__n") > 1).select("__key")
    return several.unionByName(new.select(key)).distinct()


def _target(replica: str | Target) -> Target:
    return PathReplica(replica) if isinstance(replica, str) else replica


def apply_increment(
    spark: SparkSession,
    replica: str | Target,
    increment_path: str,
    staging_root: str,
    strategy: str = CLOSED_KEY,
    spec: ScdSpec = DEFAULT,
    run_id: str | None = None,
    compact: bool = False,
    reject: bool = False,
    file_bytes: int = FILE_BYTES,
    most_small: int = MOST_SMALL,
) -> DataFrame:
    """Stage the changes of one increment, publish them and scan the new replica.

    The replica is a path or a target, and the staging root is its own. By
    sub-partition, only start months with closed keys are read, staged and replaced; by
    file (and always for the latest version) only files that hold a replaced row. Open rows
    elsewhere stay in place. Where a month that gets rows holds more than ``most_small`` small
    files (below a quarter of ``file_bytes``), these are merged along with the run; see
    ``compact_replica``. With ``compact`` all staged rows are brought together by month. With ``reject`` increment rows without two usable dates
    are set apart and not applied; see ``rejected_rows``.

    Staged rows are compared with the published ones before anything is replaced. Refuses
    to start while an earlier run on this replica is unfinished, whatever its staging root. A
    ``run_id`` given by the caller is also refused when it was used before, which guards
    against applying one increment twice. The files a run replaces stay until the next
    one is published, for ``undo_run``.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}, not one of {', '.join(STRATEGIES)}")
    target = _target(replica)
    if strategy in (BY_SUBPARTITION, BY_FILE) and target.attach:
        raise ValueError("attaching replaces the open slice as a whole; choose another strategy")
    increment = read_increment(spark, increment_path)
    work, schema = _begun(
        spark, target, staging_root, strategy, spec, run_id,
        before=lambda schema: conform(increment, spark.createDataFrame([], schema), spec),
    )
    empty = spark.createDataFrame([], schema)
    counts: dict[str, int] = {}
    if reject:
        increment, counts = _sifted(work, increment)
    if strategy == LATEST:
        increment = by_address.addressed(increment)
    new = conform(increment, _with_address(empty) if strategy == LATEST else empty, spec)
    # listed after the claim: no other run changes these files any more
    rows = target.open_rows(spark, schema, spec)
    if strategy == LATEST:
        changes, files = _latest_changes(work, rows, new, compact)
    else:
        changes, files = _closed_key_changes(work, rows, new, strategy, compact)
    seen = _staged(work, changes)
    merged = packed(_sizes_of_touched(work, files), file_bytes, most_small)
    bins: list[str] = []
    if merged:
        first = set(_staged_files(work))
        files, more = [*files, *merged], _staged(work, _of_bins(work, schema, merged), more=True)
        seen = {kind: _together(seen[kind], more[kind]) for kind in seen}
        bins = sorted(set(_staged_files(work)) - first)
    work.notes.create("staged.json", {"replaced": files, "seen": seen, "counts": counts, "bins": bins})
    return _publish(work, schema)


def _begun(
    spark: SparkSession,
    target: Target,
    staging_root: str,
    strategy: str,
    spec: ScdSpec,
    run_id: str | None,
    before: Callable[[T.StructType], object] | None = None,
) -> tuple[_Work, T.StructType]:
    """Claim the replica for a new run; ``before`` may refuse it by the replica's schema."""
    target.check(spark)
    ledger = Ledger(spark, target.location(spark))
    ledger.free()
    run_id = run_id or uuid4().hex
    if ledger.outcome(run_id) not in (None, UNDONE):
        raise RuntimeError(f"run {run_id} was made before")
    current = None if ledger.schema() and ledger.has_entries() else target.scan(spark, spec)
    schema = _schema(spark, target, ledger, spec, current)
    if before is not None:
        before(schema)
    bind(spark, staging_root, target.identity)
    run = Run(run_id, target.identity, staging_root.rstrip("/"), strategy, repr(astuple(spec)))
    work = _Work(spark, target, ledger, ledger.take(run), run, spec)
    if not target.attach:
        _clear(work)  # of a run that the replica does not know any more
    if not ledger.has_entries():
        ledger.enter(0, "", _months(added=_held_now(work)), read=None, rejected=None)
    return work, schema


def compact_replica(
    spark: SparkSession,
    replica: str | Target,
    staging_root: str,
    spec: ScdSpec = DEFAULT,
    run_id: str | None = None,
    file_bytes: int = FILE_BYTES,
    most_small: int = MOST_SMALL,
) -> DataFrame:
    """Merge the small files of every month that holds more than ``most_small`` of them.

    Files below a quarter of ``file_bytes`` are packed into files of up to that size; all
    others stay. A run like any other: claimed, compared, entered in the ledger, resumed and
    undone. Open partitions of an attaching table are passed by, since each run writes
    them anew. Where no month is due nothing changes.
    """
    target = _target(replica)
    work, schema = _begun(spark, target, staging_root, COMPACTION, spec, run_id)
    ends = [n for n in Folder(spark, work.location).names() if n.startswith(f"{spec.part_to}=")]
    merged = packed(_sizes(work, ends), file_bytes, most_small)
    if not merged:
        work.ledger.finish(work.number, work.run, ABANDONED)
        return target.scan(spark, spec, schema)
    seen = _staged(work, _of_bins(work, schema, merged))
    note = {"replaced": sorted(merged), "seen": seen, "counts": {}, "bins": sorted(_staged_files(work))}
    work.notes.create("staged.json", note)
    return _publish(work, schema)


def _sizes(work: _Work, ends: list[str]) -> dict[str, int]:
    """Bytes of the files below some end months, but for partitions that lie elsewhere."""
    if work.target.attach:
        ends = [e for e in ends if e != open_name(work.spec)]
    return sizes_below(work.spark, work.location, ends)


def _sizes_of_touched(work: _Work, replaced: list[str]) -> dict[str, int]:
    """Bytes of the files that stay in the months for which rows are staged."""
    ends = [n for n in Folder(work.spark, work.staged_at).names() if "=" in n]
    months = {month_name(f) for f in files_below(work.spark, work.staged_at, ends)}
    gone = set(replaced)
    sizes = _sizes(work, ends)
    return {f: n for f, n in sizes.items() if month_name(f) in months and f not in gone}


def _of_bins(work: _Work, schema: T.StructType, merged: dict[str, int]) -> DataFrame:
    return dealt(read_files(work.spark, work.location, schema, sorted(merged)), merged, work.spec)


def _together(one: list[int], two: list[int]) -> list[int]:
    """The fingerprint of two bags in one."""
    return [one[0] + two[0], one[1] ^ two[1], one[2] + two[2]]


def _with_address(empty: DataFrame) -> DataFrame:
    return empty.withColumns(
        {by_address.FILE: F.lit("").cast("string"), by_address.ROW: F.lit(0).cast("bigint")}
    )


def _staged(work: _Work, changes: DataFrame, more: bool = False) -> dict[str, list]:
    """Write rows of the run; their fingerprints come with the write."""
    seen = Observation()
    opened = F.coalesce(in_open_partition(work.spec), F.lit(False))
    of_open = [c.alias(f"open_{n}") for c, n in zip(fingerprint(changes, opened), PARTS, strict=True)]
    observed = changes.observe(seen, *fingerprint(changes), *of_open)
    if more:
        stage_more(observed, work.staged_at, work.spec)
    else:
        stage(observed, work.staged_at, work.spec, rebalance=False)
    got = seen.get
    return {
        "all": [int(got[p]) for p in PARTS],
        "open": [int(got[f"open_{p}"]) for p in PARTS],
    }


def _sifted(work: _Work, increment: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """The increment without rows that lack a usable date, which are kept beside it.

    One pass writes both and counts both.
    """
    seen, usable = Observation(), usable_dates(increment, work.spec)
    marked = increment.withColumn("__usable", usable).observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(~F.col("__usable")).alias("rejected")
    )
    path = f"{work.run.root}/sifted/run_id={work.run.run_id}"
    marked.write.partitionBy("__usable").parquet(path)
    got = seen.get
    schema = T.StructType(increment.schema.fields)
    reader = work.spark.read.schema(schema)
    if not Folder(work.spark, path).exists("__usable=true"):
        work.spark.createDataFrame([], schema).write.parquet(f"{path}/__usable=true")
    return reader.parquet(f"{path}/__usable=true"), got


def rejected_rows(spark: SparkSession, staging_root: str, run_id: str) -> DataFrame:
    """Increment rows that a run has set apart, as they came."""
    path = f"{staging_root.rstrip('/')}/sifted/run_id={run_id}"
    return spark.read.parquet(path).filter("NOT __usable").drop("__usable")


def _schema(
    spark: SparkSession, target: Target, ledger: Ledger, spec: ScdSpec, current: DataFrame | None = None
) -> T.StructType:
    """The declared schema of a path (its own on the first run), the catalog's of a table."""
    if not isinstance(target, PathReplica):
        return target.scan(spark, spec).schema
    held = ledger.schema()
    if held is None:
        held = (target.scan(spark, spec) if current is None else current).schema
        ledger.declare(held)
    return held


# Numbers that hold all values of another type, by their simple names: fixed values.
_WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
}


def declare_schema(
    spark: SparkSession, path: str, schema: T.StructType, spec: ScdSpec = DEFAULT
) -> T.StructType:
    """Let a path replica grow: new nullable columns, and wider numbers. Anything else is refused.

    Months written before read as null in a new column. The two months stay last.
    """
    ledger = Ledger(spark, path)
    ledger.free()
    held = _schema(spark, PathReplica(path), ledger, spec)
    given = {f.name: f for f in schema.fields}
    gone = [f.name for f in held.fields if f.name not in given]
    if gone:
        raise ValueError(f"columns cannot go: {', '.join(gone)}")
    for old in held.fields:
        kind, wanted = old.dataType, given[old.name].dataType
        decimals = isinstance(kind, T.DecimalType) and isinstance(wanted, T.DecimalType)
        if decimals:
            fits = wanted.scale >= kind.scale and (
                wanted.precision - wanted.scale >= kind.precision - kind.scale
            )
        else:
            fits = wanted == kind or wanted.simpleString() in _WIDER.get(kind.simpleString(), ())
        if not fits:
            raise ValueError(f"{old.name}: {kind.simpleString()} cannot become {wanted.simpleString()}")
    new = [f for f in schema.fields if f.name not in held.names]
    strict = [f.name for f in new if not f.nullable]
    if strict:
        raise ValueError(f"new columns must be nullable: {', '.join(strict)}")
    body = [given[f.name] for f in held.fields if f.name not in spec.partitioning]
    grown = T.StructType([*body, *new, *[held[c] for c in spec.partitioning]])
    ledger.declare(grown)
    return grown


def resume_run(
    spark: SparkSession,
    replica: str | Target,
    staging_root: str,
    run_id: str,
    spec: ScdSpec = DEFAULT,
) -> DataFrame:
    """Finish a run that broke off; one that broke while staging is given up.

    Takes the claim over, so an attempt that is still alive stops before it writes. Files
    that a broken append has left go, and the staged rows are appended again.
    """
    target = _target(replica)
    target.check(spark)
    ledger = Ledger(spark, target.location(spark))
    held, over = ledger.current(), ledger.outcome(run_id)
    if held is None or held.run is None or held.run.run_id != run_id:
        if over is None:
            raise ValueError(f"no run {run_id} on {target.identity}")
        return target.scan(spark, spec)
    run = held.run
    if (run.target, run.spec) != (target.identity, repr(astuple(spec))):
        raise ValueError(f"run {run_id} is one of {run.target} with {run.spec}")
    if run.root != staging_root.rstrip("/"):
        raise ValueError(f"run {run_id} is staged under {run.root}")
    work = _Work(spark, target, ledger, ledger.take(run, held.number), run, spec)
    if run.kind == "undo":
        return _undo(work)
    if over in (PUBLISHED, ABANDONED) or not work.notes.exists("staged.json"):
        ledger.check(work.number)
        if over in (None, UNDONE):
            _clear(work)
        ledger.finish(work.number, run, PUBLISHED if over == PUBLISHED else ABANDONED)
        return target.scan(spark, spec)
    return _publish(work, _schema(spark, target, ledger, spec))


def _staged_files(work: _Work) -> dict[str, int]:
    """Names of the files that a run has staged, with the bytes of each."""
    folders = [n for n in Folder(work.spark, work.staged_at).names() if "=" in n]
    return sizes_below(work.spark, work.staged_at, folders)


def _to_append(work: _Work, schema: T.StructType, bins: list[str]) -> DataFrame:
    """Staged rows in tasks of even size, as a write sorts all rows of a task by month.

    A task that scans staged files would hold as many rows as these pack into its bytes.
    Bins stay the files they are, and so do few bytes in all, which fit any task.
    """
    spark, spec = work.spark, work.spec
    held, packed_files = _staged_files(work), set(bins)
    if sum(n for f, n in held.items() if f not in packed_files) <= FEW:
        return _of_append(work, spark.read.schema(schema).parquet(work.staged_at))
    if not bins:
        return by_month(_of_append(work, spark.read.schema(schema).parquet(work.staged_at)), spec)
    others = sorted(set(held) - packed_files)
    changes, packed_rows = (
        _of_append(work, read_files(spark, work.staged_at, schema, names)) for names in (others, bins)
    )
    return by_month(changes, spec).unionByName(packed_rows)


def _of_append(work: _Work, staged: DataFrame) -> DataFrame:
    """The rows that are appended: an attaching table takes its open ones as they are staged."""
    if not work.target.attach:
        return staged
    return staged.filter(~F.coalesce(in_open_partition(work.spec), F.lit(False)))


def _published_files(work: _Work) -> Callable[[], list[str]]:
    """Lists the files of the months that a run appends to."""
    folders = [n for n in Folder(work.spark, work.staged_at).names() if "=" in n]
    if work.target.attach:
        folders = [f for f in folders if f != open_name(work.spec)]
    return lambda: files_below(work.spark, work.location, folders)


def _publish(work: _Work, schema: T.StructType) -> DataFrame:
    """Append the staged rows, compare, then let go of the files they replace."""
    spark, target, ledger, spec = work.spark, work.target, work.ledger, work.spec
    staged_note = work.notes.read("staged.json")
    replaced, seen = staged_note["replaced"], staged_note["seen"]
    listed = _published_files(work)
    if not work.notes.exists("appended.json"):
        began = work.notes.read("before.json")
        ledger.check(work.number)
        if began is None:
            before = listed()
            work.notes.create("before.json", {"files": before})
        else:
            before = began["files"]
            left = sorted(set(listed()) - set(before))
            target.drop_files(spark, left, spec)
        target.append(_to_append(work, schema, staged_note.get("bins", [])), spec)
        work.notes.create("appended.json", {"files": sorted(set(listed()) - set(before))})
    arrived = work.notes.read("appended.json")["files"]
    ledger.check(work.number)
    _compare(work, schema, arrived, replaced, seen, staged_note["counts"])
    record = {"arrived": arrived, "replaced": replaced, "before": _open_root(work)}
    held = Folder(spark, work.location)
    if not held.exists(f"{work.aside}.json"):
        held.create(f"{work.aside}.json", record)
    ledger.check(work.number)
    if work.swaps:
        own = open_name(spec)
        held.move(own, f"{work.aside}/{own}")
        target.point_at(spark, work.staged_at, spec)
        ledger.folder.put("open.json", {"root": work.staged_at})
    target.retire(spark, replaced, work.aside, spec)
    ledger.finish(work.number, work.run, PUBLISHED)
    _let_go(work, keep_before=record["before"])
    return target.scan(spark, spec, schema)


def _open_root(work: _Work) -> str | None:
    """The staged folder that an attaching table points at before this run."""
    if not work.target.attach:
        return None
    held = work.ledger.folder.read("open.json")
    return held and held["root"]


def _let_go(work: _Work, keep_before: str | None) -> None:
    """Keep what undoing this run needs, drop what undoing earlier ones needed."""
    undo = Folder(work.spark, f"{work.location}/{FOLDER}/undo")
    for name in undo.names():
        if name.removesuffix(".json") != work.run.run_id:
            undo.delete(name)
    keep = (work.run.run_id, keep_before and keep_before.rsplit("run_id=", 1)[1])
    drop_staged(work.spark, work.run.root, keep)


def _compare(
    work: _Work,
    schema: T.StructType,
    arrived: list[str],
    replaced: list[str],
    seen: dict[str, list],
    counts: dict[str, int],
) -> None:
    """Stop before anything is replaced if the appended files do not hold the staged rows.

    Enters the changes of each month into the ledger.
    """
    spark, spec = work.spark, work.spec
    new = read_files(spark, work.location, schema, arrived)
    months = [named(c).cast("string") for c in spec.partitioning]
    parts = {
        (ends, starts): [int(part) for part in of_month]
        for ends, starts, *of_month in new.groupBy(*months).agg(*fingerprint(new)).collect()
    }
    got, want = reduce(_together, parts.values(), [0, 0, 0]), seen["all"]
    if work.target.attach:
        want = [want[0] - seen["open"][0], want[1] ^ seen["open"][1], want[2] - seen["open"][2]]
    if got != want:
        raise RuntimeError(
            f"the published rows do not agree with the staged ones: {got[0]} rows for {want[0]}"
        )
    # counted once: a resumed attempt may find replaced files moved already
    if work.notes.exists("entered.json"):
        return
    added = {month: n for month, (n, *_) in parts.items()}
    removed = month_counts(spark, work.location, replaced, spec)
    if work.swaps:
        staged = spark.read.schema(schema).parquet(work.staged_at)
        added |= _counted(staged.filter(in_open_partition(spec)), spec)
        removed |= _counted(work.target.open_rows(spark, schema, spec), spec)
    work.ledger.enter(
        work.number, work.run.run_id, _months(added, removed),
        read=counts.get("read"), rejected=counts.get("rejected"),
    )
    work.notes.create("entered.json", {})


def _counted(rows: DataFrame, spec: ScdSpec) -> dict[tuple, int]:
    """Rows by month where partitions may lie anywhere; months are bounded by the calendar."""
    months = [named(c).cast("string") for c in spec.partitioning]
    counted = rows.groupBy(*months).agg(F.count(F.lit(1)))
    return {(ends, starts): n for ends, starts, n in counted.collect()}


def _held_now(work: _Work) -> dict[tuple, int]:
    """Rows by month that the replica holds."""
    if work.target.attach:
        return _counted(work.target.scan(work.spark, work.spec), work.spec)
    if not any("=" in name for name in Folder(work.spark, work.location).names()):
        return {}
    return month_counts(work.spark, work.location, None, work.spec)


def _months(added: dict[tuple, int], removed: dict[tuple, int] | None = None) -> list[dict]:
    removed = removed or {}
    return [
        {"ends": m[0], "starts": m[1], "added": added.get(m, 0), "removed": removed.get(m, 0)}
        for m in sorted({*added, *removed}, key=str)
    ]


def undo_run(
    spark: SparkSession, replica: str | Target, run_id: str, spec: ScdSpec = DEFAULT
) -> DataFrame:
    """Bring back the replica as it was before its last published run.

    Files that the run replaced return, those it added go. Only the last run can be undone;
    afterwards its id may be used again.
    """
    target = _target(replica)
    target.check(spark)
    ledger = Ledger(spark, target.location(spark))
    done = ledger.folder.read(f"runs/{run_id}.json")
    if not done or done.get("state") != PUBLISHED or not ledger.folder.exists(f"undo/{run_id}.json"):
        raise ValueError(f"run {run_id} is not the last published run of {target.identity}")
    run = Run(run_id, target.identity, done["root"], done["strategy"], done["spec"], "undo")
    if run.spec != repr(astuple(spec)):
        raise ValueError(f"run {run_id} is one with {run.spec}")
    return _undo(_Work(spark, target, ledger, ledger.take(run), run, spec))


def _undo(work: _Work) -> DataFrame:
    spark, target, spec = work.spark, work.target, work.spec
    held = Folder(spark, work.location)
    record = held.read(f"{work.aside}.json")
    work.ledger.check(work.number)
    if record is not None:
        if work.swaps:
            own = open_name(spec)
            held.move(f"{work.aside}/{own}", own)
            target.point_at(spark, record["before"] or work.location, spec)
            work.ledger.folder.put("open.json", {"root": record["before"]})
        target.restore(spark, record["replaced"], work.aside, spec)
        target.drop_files(spark, record["arrived"], spec)
        work.ledger.strike(work.run.run_id)
        held.delete(work.aside)
        held.delete(f"{work.aside}.json")
    work.ledger.finish(work.number, work.run, UNDONE)
    _clear(work)
    return target.scan(spark, spec)


def _clear(work: _Work) -> None:
    """Delete what a run has in its staging root."""
    root = Folder(work.spark, work.run.root)
    for kind in ("data", "notes", "sifted"):
        root.delete(f"{kind}/run_id={work.run.run_id}")


def reconcile_chain(
    spark: SparkSession, replica: str | Target, spec: ScdSpec = DEFAULT
) -> DataFrame:
    """Rows of each month by the ledger of all runs, and those the replica holds now.

    Holds after any number of increments. ``ok`` is false for a month that lost or won
    rows outside of the runs.
    """
    target = _target(replica)
    ledger = Ledger(spark, target.location(spark))
    rows = target.scan(spark, spec).select(
        named(spec.part_to).cast("string").alias("ends"),
        named(spec.part_from).cast("string").alias("starts"),
    )
    actual = rows.groupBy("ends", "starts").agg(F.count(F.lit(1)).alias("actual"))
    entered = ledger.entries().filter("added IS NOT NULL")
    sides = entered.select(
        "ends", "starts", (F.col("added") - F.col("removed")).alias("expected"),
        F.lit(0).cast("bigint").alias("actual"),
    ).unionByName(
        actual.select("ends", "starts", F.lit(0).cast("bigint").alias("expected"), "actual")
    )
    both = sides.groupBy("ends", "starts").agg(
        F.sum("expected").alias("expected"), F.sum("actual").alias("actual")
    )
    return both.filter("expected <> 0 OR actual <> 0").select(
        F.col("ends").cast("date").alias(spec.part_to),
        F.col("starts").cast("date").alias(spec.part_from),
        "expected",
        "actual",
        (F.col("expected") == F.col("actual")).alias("ok"),
    )
