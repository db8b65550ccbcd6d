"""Staging, publishing and finishing broken runs, on the golden rows."""

import os
from collections import Counter
from datetime import date, datetime
from uuid import uuid4

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import golden
import ledgerfold as lf
from ledgerfold.operators.hits import FILE, ROW
from ledgerfold.plans import jobs
from ledgerfold.sources.ledger import Ledger, Run
from ledgerfold.sources.staging import staged_path, write_replica

COLUMNS = ("id", "payload", "eff_from_dt", "eff_to_dt")


def bag(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


class Stored:
    """The golden replica and increment on disk."""

    def __init__(self, spark, folder, replica=golden.REPLICA, increment=golden.INCREMENT):
        self.spark = spark
        self.replica, self.increment = f"{folder}/replica", f"{folder}/increment"
        self.staging, self.folder = f"{folder}/staging", folder
        rows = lf.with_months(spark.createDataFrame(replica, golden.SCHEMA))
        write_replica(rows.coalesce(1), self.replica, "errorifexists")
        spark.createDataFrame(increment, golden.SCHEMA).coalesce(1).write.parquet(self.increment)

    def apply(self, strategy="closed_key", **options):
        return lf.apply_increment(
            self.spark, self.replica, self.increment, self.staging, strategy, **options
        )

    def read(self):
        return lf.read_replica(self.spark, self.replica)

    def ledger(self):
        return Ledger(self.spark, self.replica)

    def months(self, slice_):
        return {p.name for p in (self.folder / "replica" / slice_).iterdir() if p.is_dir()}


@pytest.fixture
def stored(spark, tmp_path):
    return Stored(spark, tmp_path)


def expected(strategy):
    return Counter(
        golden.expected_latest() if strategy == "latest" else golden.expected_closed_key()
    )


def test_months_come_back_as_dates(stored):
    types = dict(stored.read().dtypes)
    assert (types["eff_to_month"], types["eff_from_month"]) == ("date", "date")


def test_open_slice_is_a_partition_filter(stored, capsys):
    lf.open_slice(stored.read()).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(eff_to_month" in plan
    assert "5999-12-31" in plan


def test_seed_overwrites_and_equals(spark, stored, tmp_path):
    target = f"{tmp_path}/seeded"
    write_replica(stored.read().limit(2), target, "errorifexists")
    assert bag(lf.seed(spark, stored.replica, target)) == Counter(golden.REPLICA)


@pytest.mark.parametrize("strategy", jobs.STRATEGIES)
@pytest.mark.parametrize("limit", ["-1", "10m"], ids=["shuffled", "broadcast"])
def test_apply_increment(strategy, limit, stored, monkeypatch):
    before = stored.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(jobs, "SMALL", -1 if limit == "-1" else jobs.SMALL)
    stored.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        assert bag(stored.apply(strategy)) == expected(strategy)
    finally:
        stored.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert bag(stored.read()) == expected(strategy)
    assert stored.ledger().current() is None


@pytest.mark.parametrize(("rows", "join"), [(40000, "SortMergeJoin"), (100, "BroadcastHashJoin")])
def test_notes_are_broadcast_by_their_size_in_memory(rows, join, spark, tmp_path, capsys):
    run = Run("one", f"{tmp_path}/replica", f"{tmp_path}/staging", "latest", "")
    work = jobs._Work(spark, lf.PathReplica(run.target), None, 1, run, lf.ScdSpec())
    # the name of one file is stored once on disk, but with each of its rows in memory
    placed = spark.range(rows).select(F.lit("f" * 200).alias(FILE), F.col("id").alias(ROW))
    hits = work.noted(placed, "hits")
    assert work.notes.size("hits") < jobs.SMALL
    placed.join(hits, [FILE, ROW], "left_anti").explain()
    assert join in capsys.readouterr().out
    assert hits.count() == rows and work.is_small("hits") == (rows == 100)


@pytest.mark.parametrize("strategy", ["closed_key", "latest"])
def test_compact_merges_the_files_of_earlier_runs(strategy, stored):
    def most_files():
        folders = (stored.folder / "replica").glob("eff_to_month=5999-12-31/*")
        return max(len(list(f.glob("*.parquet"))) for f in folders)

    for key in (900, 901):
        _rewrite(stored, [(key, "new", date(2024, 6, 2), golden.OPEN)])
        stored.apply(strategy)
    assert most_files() > 1
    stored.spark.createDataFrame([], golden.SCHEMA).write.mode("overwrite").parquet(
        stored.increment
    )
    before = bag(stored.read())
    stored.apply(strategy, compact=True)
    assert most_files() == 1 and bag(stored.read()) == before


@pytest.mark.parametrize("strategy", jobs.STRATEGIES)
def test_a_vanished_subpartition_goes(strategy, stored):
    gone = "eff_from_month=2024-04-30"
    assert gone in stored.months("eff_to_month=5999-12-31")
    stored.apply(strategy)
    assert gone not in stored.months("eff_to_month=5999-12-31")
    got = {p.name for p in stored.folder.joinpath("replica").glob("*=*")}
    undated = {"eff_to_month=__HIVE_DEFAULT_PARTITION__"} if strategy != "latest" else set()
    assert got == undated | {
        "eff_to_month=2024-05-31",
        "eff_to_month=2024-06-30",
        "eff_to_month=5999-12-31",
    }


def test_subpartitions_without_closed_keys_keep_their_files(stored):
    march = stored.folder / "replica/eff_to_month=5999-12-31/eff_from_month=2024-03-31"
    before = {p.name for p in march.glob("*.parquet")}
    stored.apply("closed_key_by_subpartition")
    assert before and {p.name for p in march.glob("*.parquet")} == before


def test_a_replica_may_lose_all_open_rows(spark, tmp_path):
    start, end = date(2024, 1, 5), date(2024, 3, 1)
    for strategy in ("closed_key", "closed_key_by_subpartition"):
        stored = Stored(
            spark,
            tmp_path / strategy,
            [(1, "a", start, golden.OPEN)],
            [(1, "a", start, end)],
        )
        assert bag(stored.apply(strategy)) == Counter([(1, "a", start, end)])


def test_an_empty_increment_changes_nothing(spark, tmp_path):
    for strategy in jobs.STRATEGIES:
        stored = Stored(spark, tmp_path / strategy, increment=[])
        assert bag(stored.apply(strategy)) == Counter(golden.REPLICA)


def test_closed_months_of_earlier_runs_stay(stored):
    stored.apply()
    before = bag(lf.closed_slice(stored.read()))
    stored.spark.createDataFrame(
        [(2, "r2", date(2024, 1, 11), date(2024, 5, 31))], golden.SCHEMA
    ).write.mode("overwrite").parquet(stored.increment)
    stored.apply()
    added = Counter([(2, "r2", date(2024, 1, 11), date(2024, 5, 31))])
    assert bag(lf.closed_slice(stored.read())) == before + added


def test_staging_is_never_overwritten(spark, stored, tmp_path):
    path = f"{tmp_path}/staged"
    lf.stage(stored.read(), path)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        lf.stage(stored.read(), path)


def test_a_published_run_is_not_made_again(stored):
    stored.apply(run_id="day-1")
    with pytest.raises(RuntimeError, match="made before"):
        stored.apply(run_id="day-1")
    assert bag(stored.read()) == expected("closed_key")


def test_an_increment_that_does_not_fit_leaves_no_run(stored):
    stored.spark.createDataFrame([(1,)], "id bigint").write.mode("overwrite").parquet(
        stored.increment
    )
    with pytest.raises(ValueError, match="lacks"):
        stored.apply()
    assert stored.ledger().current() is None


def test_staged_rows_stay_until_the_next_run(stored):
    stored.apply(run_id="day-1")
    assert os.path.exists(staged_path(stored.staging, "day-1"))
    assert not os.path.exists(f"{stored.staging}/notes")
    stored.apply(run_id="day-2")
    assert not os.path.exists(staged_path(stored.staging, "day-1"))


class Tabled(Stored):
    """The same with the replica as a catalog table."""

    def __init__(self, spark, folder, attach=False):
        super().__init__(spark, folder)
        self.name = f"replica_{uuid4().hex}"
        schema = lf.read_replica(spark, self.replica).schema
        self.replica = lf.create_replica(spark, self.name, schema, f"{folder}/table", attach=attach)
        rows = lf.read_replica(spark, f"{folder}/replica")
        rows.write.insertInto(self.name)

    def read(self):
        return self.spark.table(self.name)


@pytest.fixture
def tabled(spark, tmp_path):
    made = Tabled(spark, tmp_path)
    yield made
    spark.sql(f"DROP TABLE {made.name}")


@pytest.fixture
def attached(spark, tmp_path):
    made = Tabled(spark, tmp_path, attach=True)
    yield made
    spark.sql(f"DROP TABLE {made.name}")


@pytest.mark.parametrize("strategy", jobs.STRATEGIES)
def test_apply_increment_to_a_table(strategy, tabled):
    assert bag(tabled.apply(strategy)) == expected(strategy)
    months = {r[0] for r in tabled.spark.sql(f"SHOW PARTITIONS {tabled.name}").collect()}
    assert "eff_to_month=5999-12-31/eff_from_month=2024-04-30" not in months
    if strategy != "latest":
        assert len(months) == 11
    folder = tabled.folder / "table/eff_to_month=5999-12-31/eff_from_month=2024-04-30"
    assert not folder.exists()


def test_table_scan_prunes_to_the_open_partitions(tabled, capsys):
    tabled.apply()
    lf.open_slice(tabled.read()).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(eff_to_month" in plan


@pytest.mark.parametrize("strategy", ["closed_key", "latest"])
def test_attached_open_rows_are_not_written_again(strategy, attached):
    attached.apply(strategy, run_id="day-1")
    assert bag(attached.read()) == expected(strategy)
    files = {r[0] for r in lf.open_slice(attached.read()).select("_metadata.file_path").collect()}
    assert files and all("run_id=day-1" in f for f in files)


def test_attached_runs_follow_each_other(attached):
    attached.apply(run_id="day-1")
    closing = (2, "r2", date(2024, 1, 11), date(2024, 5, 31))
    attached.spark.createDataFrame([closing], golden.SCHEMA).write.mode("overwrite").parquet(
        attached.increment
    )
    attached.apply(run_id="day-2")
    opened = (2, "r2", date(2024, 1, 11), golden.OPEN)
    once = expected("closed_key") - Counter([opened]) + Counter([closing])
    assert bag(attached.read()) == once
    attached.apply(run_id="day-3")
    assert bag(attached.read()) == once + Counter([closing])
    first, *others = (staged_path(attached.staging, f"day-{n}") for n in (1, 2, 3))
    assert not os.path.exists(first)
    for path in others:
        assert not attached.spark.read.parquet(path).isEmpty()


def test_attached_rows_without_a_start(spark, attached):
    undated = (99, "rX", None, golden.OPEN)
    spark.createDataFrame([undated], golden.SCHEMA).write.mode("overwrite").parquet(
        attached.increment
    )
    for run in ("day-1", "day-2"):
        attached.apply(run_id=run)
    assert bag(attached.read()) == Counter([*golden.REPLICA, undated, undated])


def test_attaching_takes_the_whole_open_slice(attached):
    with pytest.raises(ValueError, match="as a whole"):
        attached.apply("closed_key_by_subpartition")


class Crash(Exception):
    pass


@pytest.mark.parametrize("merged", [False, True], ids=["changes", "bins"])
def test_appended_rows_are_spread_over_tasks_of_even_size(merged, stored, monkeypatch):
    plans = []
    monkeypatch.setattr(jobs, "FEW", 0, raising=False)

    class Breaking(lf.PathReplica):
        def append(self, added, spec):
            plans.append(added._jdf.queryExecution().optimizedPlan().toString())
            raise Crash

    if merged:  # two small files in each closed month that the increment reaches
        stored.apply()
        stored.apply()
    increment = lf.read_increment(stored.spark, stored.increment)
    want = bag(lf.merge_closed_key(stored.read(), increment))
    with pytest.raises(Crash):
        lf.apply_increment(
            stored.spark, Breaking(stored.replica), stored.increment, stored.staging,
            run_id="one", most_small=0 if merged else 32,
        )
    assert plans[0].count("RebalancePartitions") == 1
    # bins stay the files they are
    assert ("Union" in plans[0]) == merged
    assert bag(lf.resume_run(stored.spark, stored.replica, stored.staging, "one")) == want


def _crash(*args, **kwargs):
    raise Crash


BREAKS = ("while staging", "before the append", "after the append", "before the open rows")


def _break(patch, where, target):
    append = target.append

    def append_then_crash(*args, **kwargs):
        append(*args, **kwargs)
        raise Crash

    if where == "while staging":
        patch.setattr(jobs, "stage", _crash)
    elif where == "before the append":
        patch.setattr(type(target), "append", _crash)
    elif where == "after the append":
        patch.setattr(type(target), "append", lambda self, *args: append_then_crash(*args))
    else:
        patch.setattr(type(target), "point_at" if target.attach else "retire", _crash)


def _check_broken(strategy, where, stored, target, monkeypatch):
    with monkeypatch.context() as patch:
        _break(patch, where, target)
        with pytest.raises(Crash):
            stored.apply(strategy, run_id="day-1")
    with pytest.raises(RuntimeError, match="unfinished"):
        stored.apply(strategy)
    lf.resume_run(stored.spark, target, stored.staging, "day-1")
    if where == "while staging":
        assert bag(stored.read()) == Counter(golden.REPLICA)
        stored.apply(strategy)
    assert bag(stored.read()) == expected(strategy)


@pytest.mark.parametrize(
    "strategy, where", [*[("closed_key_by_file", w) for w in BREAKS], ("closed_key", BREAKS[3])]
)
def test_a_broken_run_is_finished(strategy, where, stored, monkeypatch):
    _check_broken(strategy, where, stored, lf.PathReplica(stored.replica), monkeypatch)


@pytest.mark.parametrize("where", BREAKS)
def test_a_broken_run_on_a_table_is_finished(where, attached, monkeypatch):
    _check_broken("latest", where, attached, attached.replica, monkeypatch)


def _rewrite(stored, rows):
    frame = stored.spark.createDataFrame(rows, golden.SCHEMA)
    frame.write.mode("overwrite").parquet(stored.increment)


@pytest.mark.parametrize(
    "strategy, where",
    [("closed_key", BREAKS[1]), ("closed_key_by_subpartition", BREAKS[2]), ("closed_key_by_file", BREAKS[3]), ("latest", BREAKS[2])],
)
def test_a_resumed_run_adds_rows_that_are_there_already(strategy, where, spark, tmp_path, monkeypatch):
    """Equal rows of earlier runs, closed and open, do not count as this run's."""
    both = []
    for name in ("whole", "broken"):
        stored = Stored(spark, tmp_path / name)
        stored.apply(strategy)
        target = lf.PathReplica(stored.replica)
        if name == "broken":
            with monkeypatch.context() as patch:
                _break(patch, where, target)
                with pytest.raises(Crash):
                    stored.apply(strategy, run_id="again")
            lf.resume_run(spark, target, stored.staging, "again")
        else:
            stored.apply(strategy, run_id="again")
        both.append(bag(stored.read()))
    assert both[0] == both[1]


def test_a_redelivered_open_row_outside_the_scope_is_added_once_more(spark, tmp_path, monkeypatch):
    start = date(2024, 2, 7)
    rows = [(8, "r8", start, golden.OPEN)]
    stored = Stored(spark, tmp_path, [*rows, (1, "a", date(2024, 1, 5), golden.OPEN)], rows)
    target = lf.PathReplica(stored.replica)
    with monkeypatch.context() as patch:
        _break(patch, "before the append", target)
        with pytest.raises(Crash):
            stored.apply("closed_key_by_subpartition", run_id="day-1")
    lf.resume_run(spark, target, stored.staging, "day-1")
    assert len(stored.read().collect()) == 3


def test_the_scope_of_a_broken_run_stays(spark, tmp_path, monkeypatch):
    start, end = date(2024, 1, 5), date(2024, 3, 1)
    replica = [(i, "a", start.replace(month=1 + i % 3), golden.OPEN) for i in (2, 3, 5)]
    closing = [(2, "a", start.replace(month=3), end)]
    stored = Stored(spark, tmp_path, replica, closing)
    target = lf.PathReplica(stored.replica)
    with monkeypatch.context() as patch:
        _break(patch, "before the append", target)
        with pytest.raises(Crash):
            stored.apply("closed_key_by_subpartition", run_id="day-1")
    lf.resume_run(spark, target, stored.staging, "day-1")
    assert bag(stored.read()) == Counter([r for r in replica if r[0] != 2] + closing)


def test_a_staging_root_belongs_to_one_target(spark, attached, tmp_path):
    attached.apply(run_id="a")
    other = Stored(spark, tmp_path / "other")
    with pytest.raises(ValueError, match="holds the staged rows of"):
        lf.apply_increment(spark, other.replica, other.increment, attached.staging)
    assert bag(attached.read()) == expected("closed_key")


@pytest.mark.parametrize("kind", ["attached", "tabled"])
def test_a_table_keeps_its_mode(kind, spark, request):
    made = request.getfixturevalue(kind)
    made.apply(run_id="a")
    before = bag(made.read())
    _rewrite(made, [])
    other = lf.TableReplica(made.name, attach=kind == "tabled")
    for call in (
        lambda: lf.apply_increment(spark, other, made.increment, made.staging),
        lambda: lf.resume_run(spark, other, made.staging, "a"),
    ):
        with pytest.raises(ValueError, match="is kept by"):
            call()
    assert bag(made.read()) == before


def test_attaching_leaves_no_stale_files(attached):
    attached.apply(run_id="a")
    assert not (attached.folder / "table/eff_to_month=5999-12-31").exists()


def test_exchanged_payloads_stop_a_run(stored, monkeypatch):
    """Counts agree, rows do not: nothing is replaced, and a resumed run appends again."""
    before, target = bag(stored.read()), lf.PathReplica(stored.replica)
    append = type(target).append

    def spoilt(self, rows, spec):
        other = F.when(F.col("id") == 1, "swapped").otherwise(F.col("payload"))
        append(self, rows.withColumn("payload", other), spec)

    with monkeypatch.context() as patch:
        patch.setattr(type(target), "append", spoilt)
        with pytest.raises(RuntimeError, match="do not agree"):
            stored.apply(run_id="day-1")
    assert before - bag(stored.read()) == Counter()
    assert os.path.exists(staged_path(stored.staging, "day-1"))
    os.remove(f"{stored.staging}/notes/run_id=day-1/appended.json")
    lf.resume_run(stored.spark, target, stored.staging, "day-1")
    assert bag(stored.read()) == expected("closed_key")


def test_a_run_is_resumed_by_its_own_target(spark, stored, monkeypatch):
    with monkeypatch.context() as patch:
        _break(patch, "before the append", lf.PathReplica(stored.replica))
        with pytest.raises(Crash):
            stored.apply(run_id="day-1")
    with pytest.raises(ValueError, match="no run"):
        lf.resume_run(spark, f"{stored.replica}-other", stored.staging, "day-1")
    with pytest.raises(ValueError, match="is staged under"):
        lf.resume_run(spark, stored.replica, f"{stored.staging}-other", "day-1")
    with pytest.raises(ValueError, match="no run"):
        lf.resume_run(spark, stored.replica, stored.staging, "day-2")


@pytest.mark.parametrize("zone", ["UTC", "Europe/Moscow"])
def test_months_do_not_follow_the_session_zone(spark, zone):
    replica = lf.with_months(spark.createDataFrame(golden.REPLICA, golden.SCHEMA))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = (1, "a", datetime(2024, 1, 31, 23, 30), golden.OPEN)
        kind = "id bigint, payload string, eff_from_dt {}, eff_to_dt date"
        local = spark.createDataFrame([row], kind.format("timestamp_ntz"))
        got = lf.conform(local, replica).first()
        assert (got.eff_from_dt, got.eff_from_month) == (date(2024, 1, 31), date(2024, 1, 31))
        with pytest.raises(ValueError, match="instant"):
            lf.conform(spark.createDataFrame([row], kind.format("timestamp")), replica)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
