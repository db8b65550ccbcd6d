"""

Replica and increment are made from the whole ``orders`` table, for the
``_lines`` queries from the whole ``lineitem`` table. Dates leave as text.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

import ledgerfold as lf  # noqa: E402
from ledgerfold.operators.rank import ORIGIN, candidates  # noqa: E402
import scenarios as sc  # noqa: E402
from ledgerfold.session import checkpointed, scratch_path  # noqa: E402
from ledgerfold.sources.ledger import Ledger  # noqa: E402
from ledgerfold.sources.staging import by_month, write_replica  # noqa: E402
from ledgerfold.spec import DEFAULT  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

# The corpus operators and their pipeline are added only where they are installed.
try:
    from ledgerfold.llm import queries as corpus
except ImportError:
    corpus = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: merge a dirty increment by closed keys."""
    return sc.with_text_dates(_merged_once(spark, "/root/testdata/sf0.001"))


def _with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders replica after the clean increment: it has closed months."""
    first = sc.orders_increment(spark, sf_dir, dirty=False)
    return lf.merge_closed_key(sc.orders_replica(spark, sf_dir), first)


def _stored(spark: SparkSession, rows: DataFrame) -> str:
    path = scratch_path(spark, "replica")
    write_replica(by_month(rows), path, "errorifexists")
    return path


def _stored_replica(spark: SparkSession, sf_dir: str) -> str:
    """The orders replica written by month to a scratch path."""
    return _stored(spark, sc.orders_replica(spark, sf_dir))


def _stored_increment(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "increment")
    sc.orders_increment(spark, sf_dir).write.parquet(path)
    return path


def _conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.conform(sc.orders_increment(spark, sf_dir), sc.orders_replica(spark, sf_dir))


def _conform_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An increment in another order, with a column more, text for dates and other types."""
    given = sc.orders_increment(spark, sf_dir).select(
        F.col("eff_to_dt").cast("string").alias("EFF_TO_DT"),
        F.lit("noise").alias("noise"),
        "amount",
        F.col("eff_from_dt").cast("string").alias("eff_from_dt"),
        "status",
        "id",
    )
    replica = sc.orders_replica(spark, sf_dir)
    return lf.conform(given, replica.withColumn("id", F.col("id").cast("string")))


def _merged_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders replica after its dirty increment: open and closed versions."""
    return lf.merge_closed_key(
        sc.orders_replica(spark, sf_dir), sc.orders_increment(spark, sf_dir)
    )


def _scan_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.read_replica(spark, _stored_replica(spark, sf_dir))


def _scan_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.read_increment(spark, _stored_increment(spark, sf_dir))


def _seed_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.seed(spark, _stored_replica(spark, sf_dir), scratch_path(spark, "seeded"))


def _derive_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.with_months(sc.orders_increment(spark, sf_dir))


def _closed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.closed_keys(sc.orders_increment(spark, sf_dir))


def _open_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.open_slice(_merged_once(spark, sf_dir))


def _closed_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.closed_slice(_merged_once(spark, sf_dir))


def _open_subpartitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.open_subpartitions(_merged_once(spark, sf_dir))


def _new_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.new_entities(sc.orders_increment(spark, sf_dir), sc.orders_replica(spark, sf_dir))


def _new_entities_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    increment, base = sc.orders_increment(spark, sf_dir), sc.orders_replica(spark, sf_dir)
    return lf.new_entities(increment, base, dense_ids=True)


def _merge_by_subpartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    replica, increment = sc.orders_replica(spark, sf_dir), sc.orders_increment(spark, sf_dir)
    return lf.merge_closed_key_by_subpartition(replica, increment)


def _merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.merge_latest(sc.orders_replica(spark, sf_dir), sc.orders_increment(spark, sf_dir))


def _rank_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    bag = candidates(sc.orders_replica(spark, sf_dir), _conformed(spark, sf_dir))
    return lf.rank_versions(bag).drop(ORIGIN)


def _merge_closed_key_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    increment = sc.orders_increment(spark, sf_dir, dirty=False)
    return lf.merge_closed_key(sc.orders_replica(spark, sf_dir), increment)


def _merge_latest_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    increment = sc.orders_increment(spark, sf_dir, dirty=False)
    return lf.merge_latest(sc.orders_replica(spark, sf_dir), increment)


def _second_merge(merge: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """The dirty increment on a replica that went through the clean one."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        first = sc.orders_increment(spark, sf_dir, dirty=False)
        return merge(
            lf.merge_closed_key(sc.orders_replica(spark, sf_dir), first),
            sc.orders_increment(spark, sf_dir),
        )

    return run


def _merge_staged_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    replica = sc.orders_replica(spark, sf_dir)
    path = scratch_path(spark, "staging")
    lf.stage(lf.changes_closed_key(replica, sc.orders_increment(spark, sf_dir)), path)
    return lf.read_replica(spark, path, schema=replica.schema)


def _staged_on_replica(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A stored replica with closed months, and the staged changes of the dirty increment."""
    path = _stored(spark, _with_history(spark, sf_dir))
    staging, replica = scratch_path(spark, "staging"), lf.read_replica(spark, path)
    increment = lf.read_increment(spark, _stored_increment(spark, sf_dir))
    lf.stage(lf.changes_closed_key(replica, increment), staging)
    return path, lf.read_replica(spark, staging, schema=replica.schema)


def _publish_open_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, staged = _staged_on_replica(spark, sf_dir)
    lf.publish_open_slice(staged, path)
    return lf.read_replica(spark, path, schema=staged.schema)


def _publish_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, staged = _staged_on_replica(spark, sf_dir)
    lf.publish(staged, path)
    return lf.read_replica(spark, path, schema=staged.schema)


def _job(strategy: str) -> Query:
    """The whole job on storage: stage, publish, read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return lf.apply_increment(
            spark,
            _stored(spark, _with_history(spark, sf_dir)),
            _stored_increment(spark, sf_dir),
            scratch_path(spark, "staging"),
            strategy,
        )

    return run


class _Break(Exception):
    pass


class _Breaking(lf.PathReplica):
    """A replica on which a run breaks off before it appends."""

    def append(self, *args: object) -> None:
        raise _Break


def _resumed(strategy: str) -> Query:
    """The dirty increment again, on a replica that holds all its rows already; the run is
    broken and resumed, and has to add them once more."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        increment = _stored_increment(spark, sf_dir)
        once = lf.merge_closed_key(_with_history(spark, sf_dir), lf.read_increment(spark, increment))
        path, staging = _stored(spark, once), scratch_path(spark, "staging")
        return _broken_and_resumed(spark, _Breaking(path), increment, staging, strategy)

    return run


def _broken_and_resumed(
    spark: SparkSession, target: lf.PathReplica | lf.TableReplica, increment: str, staging: str, strategy: str
) -> DataFrame:
    try:
        lf.apply_increment(spark, target, increment, staging, strategy, run_id="again")
    except _Break:
        kind = type(target).__mro__[1]
        plain = kind(target.path) if kind is lf.PathReplica else kind(target.name, target.attach)
        return lf.resume_run(spark, plain, staging, "again")
    raise AssertionError("the run did not break")


class _BreakingTable(lf.TableReplica):
    """A table on which a run breaks off before its open partitions change."""

    def point_at(self, *args: object) -> None:
        raise _Break


def _resumed_attached(spark: SparkSession, sf_dir: str, table: lf.TableReplica) -> DataFrame:
    broken = _BreakingTable(table.name, attach=True)
    increment, staging = _stored_increment(spark, sf_dir), scratch_path(spark, "staging")
    return _broken_and_resumed(spark, broken, increment, staging, "closed_key")


def _refused_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run is broken; a second writer with a staging root of its own is refused and changes nothing."""
    path, increment = _stored(spark, _with_history(spark, sf_dir)), _stored_increment(spark, sf_dir)
    try:
        lf.apply_increment(spark, _Breaking(path), increment, scratch_path(spark, "staging"))
    except _Break:
        pass
    try:
        lf.apply_increment(spark, path, increment, scratch_path(spark, "other"))
    except RuntimeError:
        return lf.read_replica(spark, path)
    raise AssertionError("the second writer was let in")


def _undone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run by file, published and undone."""
    path, increment = _stored(spark, _with_history(spark, sf_dir)), _stored_increment(spark, sf_dir)
    staging = scratch_path(spark, "staging")
    lf.apply_increment(spark, path, increment, staging, "closed_key_by_file", run_id="one")
    return lf.undo_run(spark, path, "one")


def _undone_attached(spark: SparkSession, sf_dir: str, table: lf.TableReplica) -> DataFrame:
    increment, staging = _stored_increment(spark, sf_dir), scratch_path(spark, "staging")
    lf.apply_increment(spark, table, increment, staging, run_id="one")
    return lf.undo_run(spark, table, "one")


def _differing_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months in which costly pending orders were exchanged for others: counts agree there."""
    replica = sc.orders_replica(spark, sf_dir)
    costly = (F.col("status") == "P") & (F.col("amount") > 250000)
    return lf.differing_months(
        replica, replica.withColumn("amount", F.when(costly, -F.col("amount")).otherwise(F.col("amount")))
    )


def _fingerprint_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each month after both forms of the merge, and whether their fingerprints agree."""
    forms = [
        lf.fingerprint_by_month(merge(spark, sf_dir)).withColumnsRenamed({c: f"{c}_{k}" for c in ("bits", "total")})
        for k, merge in enumerate((_merged_once, _merge_by_subpartition))
    ]
    same = (F.col("bits_0") == F.col("bits_1")) & (F.col("total_0") == F.col("total_1"))
    return forms[0].join(forms[1], [*DEFAULT.partitioning, "n"], "full").select(
        *DEFAULT.partitioning, "n", same.alias("same")
    )


def _chain(fault: bool) -> Query:
    """The ledger's rows by month after three increments; with a fault, stray rows come between."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, staging = _stored_replica(spark, sf_dir), scratch_path(spark, "staging")
        dirty, clean = _stored_increment(spark, sf_dir), scratch_path(spark, "increment")
        sc.orders_increment(spark, sf_dir, dirty=False).write.parquet(clean)
        for increment in (clean, dirty, dirty):
            lf.apply_increment(spark, path, increment, staging, "closed_key_by_file")
        if fault:
            stray = lf.conform(lf.read_increment(spark, clean), lf.read_replica(spark, path))
            write_replica(by_month(lf.closed_slice(stray)), path, "append")
        return lf.reconcile_chain(spark, path)

    return run


def _unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty increment with text for dates, which new entities and late rows lack."""
    rows = sc.orders_increment(spark, sf_dir)
    end = F.when(F.col("status") == "N", F.lit("open")).otherwise(F.col("eff_to_dt").cast("string"))
    start = F.when(F.col("status") == "L", F.lit(None)).otherwise(F.col("eff_from_dt").cast("string"))
    return rows.withColumns({"eff_to_dt": end, "eff_from_dt": start})


def _rejecting(spark: SparkSession, sf_dir: str) -> tuple[str, str, DataFrame]:
    path, increment = _stored_replica(spark, sf_dir), scratch_path(spark, "increment")
    _unreadable(spark, sf_dir).write.parquet(increment)
    staging = scratch_path(spark, "staging")
    return path, staging, lf.apply_increment(spark, path, increment, staging, run_id="one", reject=True)


def _rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, staging, _ = _rejecting(spark, sf_dir)
    return lf.rejected_rows(spark, staging, "one")


def _accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replica of that run, with what it read and rejected by its ledger."""
    path, _, rows = _rejecting(spark, sf_dir)
    entry = Ledger(spark, path).entries().filter("run_id = 'one'").select("read", "rejected").distinct()
    return rows.select(*sc.ORDER).crossJoin(F.broadcast(entry))  # one row


def _grown_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replica that gets a column after its first run; earlier rows have none."""
    path, staging = _stored_replica(spark, sf_dir), scratch_path(spark, "staging")
    clean, dirty = scratch_path(spark, "clean"), scratch_path(spark, "dirty")
    sc.orders_increment(spark, sf_dir, dirty=False).write.parquet(clean)
    sc.orders_increment(spark, sf_dir).withColumn("origin", F.concat("status", F.lit("2"))).write.parquet(dirty)
    held = lf.apply_increment(spark, path, clean, staging).schema
    lf.declare_schema(spark, path, T.StructType([*held.fields, T.StructField("origin", T.StringType())]))
    return lf.apply_increment(spark, path, dirty, staging, "closed_key_by_file")


def _reconcile_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a replica that a job has published to storage."""
    base = sc.orders_replica(spark, sf_dir)
    path, increment = _stored(spark, base), scratch_path(spark, "increment")
    sc.orders_increment(spark, sf_dir, dirty=False).write.parquet(increment)
    result = lf.apply_increment(spark, path, increment, scratch_path(spark, "staging"))
    return lf.reconcile(base, lf.read_increment(spark, increment), result)


def _footer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.footer_counts(spark, _stored(spark, _merged_once(spark, sf_dir)))


def _reconcile_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a published replica without reading it: base and result by their footers."""
    base, increment = _stored_replica(spark, sf_dir), scratch_path(spark, "increment")
    sc.orders_increment(spark, sf_dir, dirty=False).write.parquet(increment)
    before = lf.footer_counts(spark, base)
    lf.apply_increment(spark, base, increment, scratch_path(spark, "staging"), "closed_key_by_file")
    return lf.reconcile_counts(before, lf.read_increment(spark, increment), lf.footer_counts(spark, base))


def _scattered(spark: SparkSession, sf_dir: str) -> str:
    """The replica with closed months, every month in 12 files that as many tasks have written."""
    rows, path = _with_history(spark, sf_dir), scratch_path(spark, "replica")
    for part in range(3):
        some = rows.filter(F.pmod(F.xxhash64("id"), F.lit(3)) == part)
        write_replica(some.repartition(4, "id"), path, "append")
    return path


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.compact_replica(spark, _scattered(spark, sf_dir), scratch_path(spark, "staging"), most_small=3)


def _compacted_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each month after an increment that merges small files along with its run, and
    whether all months that hold new rows are within their number of files."""
    path, increment = _scattered(spark, sf_dir), _stored_increment(spark, sf_dir)
    got = lf.apply_increment(
        spark, path, increment, scratch_path(spark, "staging"), "closed_key_by_file", most_small=3
    )
    touched = lf.with_months(lf.read_increment(spark, increment)).select(*DEFAULT.partitioning).distinct()
    files = got.withColumn("file", F.col("_metadata.file_path"))
    months = files.groupBy(*DEFAULT.partitioning).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("file").alias("files")
    )
    # the small files it may keep or their one bin, and those of the tasks that write the run
    tasks = 3 + spark.sparkContext.defaultParallelism + int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = months.join(F.broadcast(touched.withColumn("touched", F.lit(True))), [*DEFAULT.partitioning], "left")
    return joined.select(
        *DEFAULT.partitioning, "n", (F.col("touched").isNull() | (F.col("files") <= tasks)).alias("bounded")
    )


def _table_job(strategy: str, attach: bool) -> Query:
    """The same with the replica as a catalog table."""

    def job(spark: SparkSession, sf_dir: str, table: lf.TableReplica) -> DataFrame:
        increment, staging = _stored_increment(spark, sf_dir), scratch_path(spark, "staging")
        return lf.apply_increment(spark, table, increment, staging, strategy)

    return _on_table(job, attach)


def _on_table(job: Callable[[SparkSession, str, lf.TableReplica], DataFrame], attach: bool) -> Query:
    """Something done to the replica as a catalog table, which goes at the end."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        name, path = f"ledgerfold_{uuid4().hex}", scratch_path(spark, "table")
        rows = _with_history(spark, sf_dir)
        table = lf.create_replica(spark, name, _table_schema(rows), path, attach=attach)
        try:
            by_month(rows.select(*spark.table(name).columns)).write.insertInto(name)
            return checkpointed(job(spark, sf_dir, table))
        finally:
            spark.sql(f"DROP TABLE {name}")

    return run


def _table_schema(rows: DataFrame) -> T.StructType:
    return rows.select(*sc.ORDER, *DEFAULT.partitioning).schema


def _reconcile(dirty: bool, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = sc.orders_replica(spark, sf_dir)
        increment = sc.orders_increment(spark, sf_dir, dirty)
        return lf.reconcile(base, increment, merge(base, increment), dense_ids=True)

    return run


def _lines(merge: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return merge(sc.lines_replica(spark, sf_dir), sc.lines_increment(spark, sf_dir))

    return run


def _rank_versions_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    replica = sc.lines_replica(spark, sf_dir)
    bag = candidates(replica, lf.conform(sc.lines_increment(spark, sf_dir), replica))
    return lf.rank_versions(bag).drop(ORIGIN)


def _text_dates(query: Query) -> Query:
    return lambda spark, sf_dir: sc.with_text_dates(query(spark, sf_dir))


def merge_queries() -> dict[str, Query]:
    made: dict[str, Query] = {
        "merge_closed_key": _merged_once,
        "merge_closed_key_by_subpartition": _merge_by_subpartition,
        "merge_latest": _merge_latest,
        "rank_versions": _rank_versions,
        "scan_replica": _scan_replica,
        "scan_increment": _scan_increment,
        "seed_replica": _seed_replica,
        "derive_months": _derive_months,
        "conform_increment": _conform_increment,
        "open_slice": _open_slice,
        "closed_slice": _closed_slice,
        "open_subpartitions": _open_subpartitions,
        "closed_keys": _closed_keys,
        "new_entities": _new_entities,
        "new_entities_dense": _new_entities_dense,
        "merge_staged_roundtrip": _merge_staged_roundtrip,
        "publish_open_slice": _publish_open_slice,
        "publish_replica": _publish_replica,
        "apply_increment_closed_key": _job("closed_key"),
        "apply_increment_by_subpartition": _job("closed_key_by_subpartition"),
        "apply_increment_latest": _job("latest"),
        "apply_increment_table": _table_job("closed_key", attach=False),
        "apply_increment_by_subpartition_table": _table_job(
            "closed_key_by_subpartition", attach=False
        ),
        "apply_increment_by_file": _job("closed_key_by_file"),
        "apply_increment_by_file_table": _table_job("closed_key_by_file", attach=False),
        "refused_writer": _refused_writer,
        "resume_attached": _on_table(_resumed_attached, attach=True),
        "resume_by_file": _resumed("closed_key_by_file"),
        "undo_run": _undone,
        "undo_run_attached": _on_table(_undone_attached, attach=True),
        "differing_months": _differing_months,
        "fingerprint_by_month": _fingerprint_by_month,
        "reconcile_chain": _chain(False),
        "reconcile_chain_fault": _chain(True),
        "rejected_rows": _rejected_rows,
        "accepted_rows": _accepted_rows,
        "grown_schema": _grown_schema,
        "resume_closed_key": _resumed("closed_key"),
        "resume_by_subpartition": _resumed("closed_key_by_subpartition"),
        "reconcile_stored": _reconcile_stored,
        "reconcile_footers": _reconcile_footers,
        "footer_counts": _footer_counts,
        "compact_replica": _compacted,
        "compact_along": _compacted_months,
        "apply_increment_attached": _table_job("closed_key", attach=True),
        "apply_increment_latest_attached": _table_job("latest", attach=True),
        "reconcile_report": _reconcile(False, lf.merge_closed_key),
        "reconcile_report_dirty": _reconcile(True, lf.merge_closed_key),
        "merge_closed_key_clean": _merge_closed_key_clean,
        "merge_latest_clean": _merge_latest_clean,
        "merge_closed_key_second": _second_merge(lf.merge_closed_key),
        "merge_latest_second": _second_merge(lf.merge_latest),
        "merge_closed_key_lines": _lines(lf.merge_closed_key),
        "merge_closed_key_by_subpartition_lines": _lines(lf.merge_closed_key_by_subpartition),
        "merge_latest_lines": _lines(lf.merge_latest),
        "rank_versions_lines": _rank_versions_lines,
    }
    return {name: _text_dates(query) for name, query in made.items()}


def queries() -> dict[str, Query]:
    made = merge_queries()
    if corpus is not None:
        made |= corpus.queries()
    if corpus_pipeline is not None:
        made["pipeline"] = corpus_pipeline.run
    return made


# --- the same in SQL -------------------------------------------------------

_OPEN = "DATE '5999-12-31'"

_REPLICA = f"""
replica AS (
  SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS amount,
         CAST(o_orderdate AS DATE) AS eff_from_dt, {_OPEN} AS eff_to_dt
  FROM orders
)"""

_CLEAN_ROWS = f"""
  SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS amount,
         CAST(o_orderdate AS DATE) AS eff_from_dt, DATE '2005-05-31' AS eff_to_dt
  FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT o_orderkey, 'U', o_totalprice + 1, DATE '2005-06-01', {_OPEN}
  FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT o_orderkey + (SELECT count(*) FROM orders) + 1, 'N', o_totalprice,
         DATE '2005-06-02', {_OPEN}
  FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '2-HIGH'"""

_DIRTY_ROWS = f"""{_CLEAN_ROWS}
  UNION ALL
  SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE), DATE '2005-05-31'
  FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'
  UNION ALL
  SELECT o_orderkey, 'U', o_totalprice + 1, DATE '2005-06-01', {_OPEN}
  FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM'
  UNION ALL
  SELECT o_orderkey, 'L', o_totalprice, DATE '1990-01-15', {_OPEN}
  FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW'
  UNION ALL
  SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE), {_OPEN}
  FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"""

_LINE_COLUMNS = """l_orderkey AS id, l_linenumber AS line, l_quantity AS quantity,
         l_extendedprice AS price"""

_LINES = f"""
replica AS (
  SELECT {_LINE_COLUMNS}, l_returnflag AS flag,
         CAST(l_shipdate AS DATE) AS eff_from_dt, {_OPEN} AS eff_to_dt
  FROM lineitem
), increment AS (
  SELECT {_LINE_COLUMNS}, l_returnflag AS flag,
         CAST(l_shipdate AS DATE) AS eff_from_dt, DATE '2002-01-31' AS eff_to_dt
  FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, 'X', DATE '2002-02-01', {_OPEN}
  FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
         CAST(l_shipdate AS DATE), DATE '2001-12-15'
  FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
         CAST(l_shipdate AS DATE), {_OPEN}
  FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O'
)"""

# rows of `replica` that go on beside the increment, and the whole result
_CLOSED_KEY = f"""
survivors AS (
  SELECT * FROM replica r
  WHERE last_day(r.eff_to_dt) = {_OPEN} AND NOT EXISTS (
    SELECT 1 FROM increment c
    WHERE last_day(c.eff_to_dt) <> {_OPEN} AND c.id = r.id AND c.eff_from_dt = r.eff_from_dt)
), changes AS (
  SELECT * FROM increment UNION ALL SELECT * FROM survivors
), merged AS (
  SELECT * FROM replica WHERE last_day(eff_to_dt) <> {_OPEN} UNION ALL SELECT * FROM changes
)"""


def _latest(payload: str) -> str:
    return f"""
bag AS (
  SELECT *, 0 AS origin FROM increment
  UNION ALL
  SELECT *, 1 AS origin FROM replica WHERE last_day(eff_to_dt) = {_OPEN}
), ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY id ORDER BY eff_from_dt DESC NULLS LAST, eff_to_dt DESC NULLS LAST,
      origin, {payload}) AS rn
  FROM bag
), merged AS (
  SELECT * EXCLUDE (origin, rn) FROM ranked WHERE eff_to_dt <> {_OPEN} OR rn = 1
  UNION ALL
  SELECT * FROM replica WHERE last_day(eff_to_dt) <> {_OPEN}
)"""


_ORDER_TIES = "status, amount"
_LINE_TIES = "line, quantity, price, flag"
_DATES = "CAST(eff_from_dt AS VARCHAR) AS eff_from_dt, CAST(eff_to_dt AS VARCHAR) AS eff_to_dt"
_MONTHS = """CAST(last_day(eff_from_dt) AS VARCHAR) AS eff_from_month,
  CAST(last_day(eff_to_dt) AS VARCHAR) AS eff_to_month"""
_ORDER_DATED = f"id, status, amount, {_DATES}"
_ORDER = f"{_ORDER_DATED}, {_MONTHS}"
_LINE = f"id, line, quantity, price, flag, {_DATES}, {_MONTHS}"


def _with(*parts: str, select: str) -> str:
    return "WITH " + ", ".join(p.strip() for p in parts) + "\n" + select


def _increment(rows: str) -> str:
    return f"increment AS ({rows}\n)"


_DIRTY, _CLEAN = _increment(_DIRTY_ROWS), _increment(_CLEAN_ROWS)

# the replica after the clean increment, taken as the replica of the next merge
_SECOND = f"""
base AS (
  SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS amount,
         CAST(o_orderdate AS DATE) AS eff_from_dt, {_OPEN} AS eff_to_dt
  FROM orders
), first_increment AS ({_CLEAN_ROWS}
), replica AS (
  SELECT * FROM first_increment
  UNION ALL
  SELECT * FROM base b WHERE NOT EXISTS (
    SELECT 1 FROM first_increment c
    WHERE c.eff_to_dt <> {_OPEN} AND c.id = b.id AND c.eff_from_dt = b.eff_from_dt)
)"""


# and that after the dirty increment as well, for a run of the same increment again
_THIRD = (
    _SECOND.replace("), replica AS (", "), earlier AS (")
    + f""", {_DIRTY}, replica AS (
  SELECT * FROM increment
  UNION ALL
  SELECT * FROM earlier e WHERE last_day(e.eff_to_dt) <> {_OPEN} OR NOT EXISTS (
    SELECT 1 FROM increment c
    WHERE last_day(c.eff_to_dt) <> {_OPEN} AND c.id = e.id AND c.eff_from_dt = e.eff_from_dt)
)"""
)


def _reconcile_sql(increment: str) -> str:
    return _with(
        _REPLICA,
        increment,
        _CLOSED_KEY,
        f"""
counts AS (
  SELECT 'open' AS "check",
    (SELECT count(*) FROM replica)
      + (SELECT count(*) FROM increment WHERE id > (SELECT count(*) FROM replica)) AS expected,
    (SELECT count(*) FROM merged WHERE last_day(eff_to_dt) = {_OPEN}) AS actual
  UNION ALL
  SELECT 'closed',
    (SELECT count(*) FROM increment WHERE eff_to_dt <> {_OPEN}),
    (SELECT count(*) FROM merged WHERE last_day(eff_to_dt) <> {_OPEN})
)""",
        select='SELECT "check", expected, actual, expected = actual AS ok FROM counts',
    )


def oracle_sql() -> dict[str, str]:
    return (
        merge_sql()
        | (corpus.oracle_sql() if corpus is not None else {})
        | ({"pipeline": corpus_pipeline.ORACLE_SQL} if _pipeline_sql() else {})
    )


def _pipeline_sql() -> bool:
    return corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL is not None


def _chain_sql(stray: str) -> str:
    """Rows by month, and the stray ones of the month ``m`` beside them."""
    return f"""SELECT eff_from_month, eff_to_month, n AS expected, n + stray AS actual, stray = 0 AS ok
FROM (SELECT {_MONTHS}, count(*) AS n, any_value({stray}) AS stray FROM merged m
  GROUP BY last_day(eff_from_dt), last_day(eff_to_dt))"""


# the dirty increment with text for dates, some of which are none
_UNREADABLE = """
unreadable AS (
  SELECT *, status NOT IN ('N', 'L') AS usable FROM (
    SELECT id, status, amount,
      CASE WHEN status = 'L' THEN NULL ELSE CAST(eff_from_dt AS VARCHAR) END AS eff_from_dt,
      CASE WHEN status = 'N' THEN 'open' ELSE CAST(eff_to_dt AS VARCHAR) END AS eff_to_dt
    FROM increment)
)"""


def merge_sql() -> dict[str, str]:
    orders_latest, lines_latest = _latest(_ORDER_TIES), _latest(_LINE_TIES)
    closed_key = _with(_REPLICA, _DIRTY, _CLOSED_KEY, select=f"SELECT {_ORDER} FROM merged")
    latest = _with(_REPLICA, _DIRTY, orders_latest, select=f"SELECT {_ORDER} FROM merged")
    second = _with(_SECOND, _DIRTY, _CLOSED_KEY, select=f"SELECT {_ORDER} FROM merged")
    second_latest = _with(_SECOND, _DIRTY, orders_latest, select=f"SELECT {_ORDER} FROM merged")
    third = _with(_THIRD, _CLOSED_KEY, select=f"SELECT {_ORDER} FROM merged")
    closed_key_lines = _with(_LINES, _CLOSED_KEY, select=f"SELECT {_LINE} FROM merged")
    replica = _with(_REPLICA, select=f"SELECT {_ORDER} FROM replica")
    history = _with(_SECOND, select=f"SELECT {_ORDER} FROM replica")
    return {
        "merge_closed_key": closed_key,
        "merge_closed_key_by_subpartition": closed_key,
        "merge_latest": latest,
        "rank_versions": _with(
            _REPLICA, _DIRTY, orders_latest, select=f"SELECT {_ORDER}, rn FROM ranked"
        ),
        "scan_replica": replica,
        "scan_increment": _with(_DIRTY, select=f"SELECT {_ORDER_DATED} FROM increment"),
        "seed_replica": replica,
        "derive_months": _with(_DIRTY, select=f"SELECT {_ORDER} FROM increment"),
        "conform_increment": _with(
            _DIRTY,
            select=f"""SELECT CAST(id AS VARCHAR) AS id, status, amount, {_DATES}, {_MONTHS}
FROM increment""",
        ),
        "open_slice": closed_key + f" WHERE last_day(eff_to_dt) = {_OPEN}",
        "closed_slice": closed_key + f" WHERE last_day(eff_to_dt) <> {_OPEN}",
        "open_subpartitions": _with(
            _REPLICA,
            _DIRTY,
            _CLOSED_KEY,
            select=f"""SELECT DISTINCT CAST(last_day(eff_from_dt) AS VARCHAR) AS eff_from_month
FROM merged WHERE last_day(eff_to_dt) = {_OPEN} ORDER BY 1""",
        ),
        "closed_keys": _with(
            _DIRTY,
            select=f"""SELECT id, CAST(last_day(eff_from_dt) AS VARCHAR) AS eff_from_month,
  CAST(eff_from_dt AS VARCHAR) AS eff_from_dt
FROM increment WHERE last_day(eff_to_dt) <> {_OPEN}""",
        ),
        "new_entities": _with(
            _DIRTY,
            select=f"""SELECT {_ORDER_DATED} FROM increment i
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = i.id)""",
        ),
        "new_entities_dense": _with(
            _DIRTY,
            select=f"""SELECT {_ORDER_DATED} FROM increment
WHERE id > (SELECT count(*) FROM orders)""",
        ),
        "merge_staged_roundtrip": _with(
            _REPLICA, _DIRTY, _CLOSED_KEY, select=f"SELECT {_ORDER} FROM changes"
        ),
        "publish_open_slice": second
        + f""" WHERE last_day(eff_to_dt) = {_OPEN}
UNION ALL SELECT {_ORDER} FROM replica WHERE last_day(eff_to_dt) <> {_OPEN}""",
        "publish_replica": second,
        "apply_increment_closed_key": second,
        "apply_increment_by_subpartition": second,
        "apply_increment_latest": second_latest,
        "apply_increment_table": second,
        "apply_increment_by_subpartition_table": second,
        "apply_increment_attached": second,
        "apply_increment_latest_attached": second_latest,
        "apply_increment_by_file": second,
        "apply_increment_by_file_table": second,
        "refused_writer": history,
        "resume_attached": second,
        "resume_by_file": third,
        "resume_closed_key": third,
        "resume_by_subpartition": third,
        "undo_run": history,
        "undo_run_attached": history,
        "differing_months": _with(
            _REPLICA,
            select=f"""SELECT {_MONTHS}, count(*) AS n_left, count(*) AS n_right FROM replica
GROUP BY last_day(eff_from_dt), last_day(eff_to_dt)
HAVING count(*) FILTER (WHERE status = 'P' AND amount > 250000) > 0""",
        ),
        "fingerprint_by_month": _with(
            _REPLICA,
            _DIRTY,
            _CLOSED_KEY,
            select=f"""SELECT {_MONTHS}, count(*) AS n, true AS same FROM merged
GROUP BY last_day(eff_from_dt), last_day(eff_to_dt)""",
        ),
        "reconcile_chain": _with(_THIRD, _CLOSED_KEY, select=_chain_sql("0")),
        "reconcile_chain_fault": _with(
            _THIRD,
            _CLOSED_KEY,
            select=_chain_sql("""(SELECT count(*) FROM first_increment f
    WHERE last_day(f.eff_to_dt) = last_day(m.eff_to_dt)
      AND last_day(f.eff_to_dt) <> DATE '5999-12-31'
      AND last_day(f.eff_from_dt) = last_day(m.eff_from_dt))"""),
        ),
        "rejected_rows": _with(
            _DIRTY, _UNREADABLE, select=f"SELECT {_ORDER_DATED} FROM unreadable WHERE NOT usable"
        ),
        "accepted_rows": _with(
            _REPLICA,
            _DIRTY,
            _UNREADABLE,
            """accepted AS (
  SELECT id, status, amount, CAST(eff_from_dt AS DATE) AS eff_from_dt,
    CAST(eff_to_dt AS DATE) AS eff_to_dt
  FROM unreadable WHERE usable
)""",
            _CLOSED_KEY.replace("FROM increment", "FROM accepted"),
            select=f"""SELECT {_ORDER_DATED}, (SELECT count(*) FROM unreadable) AS "read",
  (SELECT count(*) FROM unreadable WHERE NOT usable) AS rejected FROM merged""",
        ),
        "grown_schema": _with(
            _SECOND,
            _DIRTY,
            """grown AS (
  SELECT *, CAST(NULL AS VARCHAR) AS origin FROM replica r
  WHERE last_day(r.eff_to_dt) <> DATE '5999-12-31' OR NOT EXISTS (
    SELECT 1 FROM increment c
    WHERE last_day(c.eff_to_dt) <> DATE '5999-12-31' AND c.id = r.id AND c.eff_from_dt = r.eff_from_dt)
  UNION ALL
  SELECT *, status || '2' FROM increment
)""",
            select=f"SELECT {_ORDER}, origin FROM grown",
        ),
        "reconcile_stored": _reconcile_sql(_CLEAN),
        "reconcile_footers": _reconcile_sql(_CLEAN),
        "footer_counts": _with(
            _REPLICA,
            _DIRTY,
            _CLOSED_KEY,
            select=f"""SELECT {_MONTHS}, count(*) AS n FROM merged
GROUP BY last_day(eff_from_dt), last_day(eff_to_dt)""",
        ),
        "compact_replica": history,
        "compact_along": _with(
            _SECOND,
            _DIRTY,
            _CLOSED_KEY,
            select=f"""SELECT {_MONTHS}, count(*) AS n, true AS bounded FROM merged
GROUP BY last_day(eff_from_dt), last_day(eff_to_dt)""",
        ),
        "reconcile_report": _reconcile_sql(_CLEAN),
        "reconcile_report_dirty": _reconcile_sql(_DIRTY),
        "merge_closed_key_clean": _with(
            _REPLICA, _CLEAN, _CLOSED_KEY, select=f"SELECT {_ORDER} FROM merged"
        ),
        "merge_latest_clean": _with(
            _REPLICA, _CLEAN, orders_latest, select=f"SELECT {_ORDER} FROM merged"
        ),
        "merge_closed_key_second": _with(
            _SECOND, _DIRTY, _CLOSED_KEY, select=f"SELECT {_ORDER} FROM merged"
        ),
        "merge_latest_second": _with(
            _SECOND, _DIRTY, orders_latest, select=f"SELECT {_ORDER} FROM merged"
        ),
        "merge_closed_key_lines": closed_key_lines,
        "merge_closed_key_by_subpartition_lines": closed_key_lines,
        "merge_latest_lines": _with(
            _LINES, lines_latest, select=f"SELECT {_LINE} FROM merged"
        ),
        "rank_versions_lines": _with(
            _LINES, lines_latest, select=f"SELECT {_LINE}, rn FROM ranked"
        ),
    }
