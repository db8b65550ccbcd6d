"""What the plans read, shuffle and join, on a stored replica and increment."""

import contextlib
import io
import re

import pytest

import ledgerfold as lf
import scenarios as sc
from ledgerfold.operators import hits
from ledgerfold.sources.staging import by_month, write_replica


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("plans")
    write_replica(by_month(sc.orders_replica(spark, sf_dir)), f"{folder}/replica", "errorifexists")
    sc.orders_increment(spark, sf_dir).write.parquet(f"{folder}/increment")
    return (
        lf.read_replica(spark, f"{folder}/replica"),
        lf.read_increment(spark, f"{folder}/increment"),
    )


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def tree(df):
    return plan(df).split("\n(1) ")[0]


def test_closed_keys_read_three_columns_and_push_the_test(stored):
    text = plan(lf.closed_keys(stored[1]))
    assert "ReadSchema: struct<id:bigint,eff_from_dt:date,eff_to_dt:date>" in text
    assert "LessThan(eff_to_dt,5999-12-01)" in text and "GreaterThan(eff_to_dt,5999-12-31)" in text


def test_slices_are_partition_filters(stored):
    for df in (lf.open_slice(stored[0]), lf.closed_slice(stored[0])):
        assert re.search(r"PartitionFilters: \[isnotnull\(eff_to_month", plan(df))
        assert "Exchange" not in tree(df)


def test_open_subpartitions_read_no_data_column(stored):
    assert "ReadSchema: struct<>" in plan(lf.open_subpartitions(stored[0]))


def test_small_keys_are_broadcast_by_size(stored):
    shape = tree(lf.merge_closed_key(*stored))
    assert "BroadcastHashJoin LeftAnti BuildRight" in shape
    assert "SortMergeJoin" not in shape


def test_large_keys_shuffle_the_open_rows_once(stored, no_broadcast):
    text = plan(lf.merge_closed_key(*stored))
    assert "SortMergeJoin LeftAnti" in text
    by_version = re.findall(r"hashpartitioning\(id#\d+L?, eff_from_dt#\d+, ", text)
    by_key_and_month = re.findall(r"hashpartitioning\(id#\d+L?, eff_from_month#\d+, eff_from", text)
    assert (len(by_version), len(by_key_and_month)) == (2, 1)


def test_subpartition_merge_prunes_by_the_closed_months(stored):
    text = plan(lf.merge_closed_key_by_subpartition(*stored))
    assert "dynamicpruning" in text
    assert not re.search(r"hashpartitioning\(id#\d+L?, status", text)


PAYLOAD = ("status", "amount")


def exchanged(df):
    """Columns that pass each exchange of a plan."""
    return re.findall(r"\) (?:Exchange|BroadcastExchange)\nInput \[\d+\]: \[([^\]]*)\]", plan(df))


def test_hits_are_found_without_payload(stored, no_broadcast):
    replica, increment = stored
    spec, new = lf.ScdSpec(), lf.conform(increment, replica)
    placed = hits.addressed(lf.open_slice(replica))
    found = hits.closed_hits(placed, lf.closed_keys(new), spec)
    shuffled = exchanged(found)
    assert shuffled and not any(c in s for s in shuffled for c in PAYLOAD)
    text = plan(found)
    assert "dynamicpruning" in text and not re.search(r"ReadSchema: struct<[^>]*amount", text)


def test_the_latest_version_is_ranked_without_payload(stored, no_broadcast, spark):
    replica, increment = stored
    spec = lf.ScdSpec()
    new = hits.addressed(increment)
    contested = spark.range(5).selectExpr("id AS __key")
    placed = hits.addressed(lf.open_slice(replica))
    best = hits.best_versions(placed, new, contested, spec)
    winners = best.drop("__n")
    for df in (best, hits.latest_hits(placed, contested, winners, spec)):
        shuffled = exchanged(df)
        assert shuffled and not any(c in s for s in shuffled for c in PAYLOAD)
    # the best rows of a task alone pass the shuffle
    assert "WindowGroupLimit" in plan(best)


def test_reconcile_counts_each_table_once(stored, spark, tmp_path):
    replica, increment = stored
    lf.merge_closed_key(replica, increment).write.partitionBy(
        "eff_to_month", "eff_from_month"
    ).parquet(f"{tmp_path}/result")
    result = lf.read_replica(spark, f"{tmp_path}/result")
    text = plan(lf.reconcile(replica, increment, result))
    # one scan each, and the keys of the base
    assert len(re.findall(r"Scan parquet  \(", text)) == 4
    latest = plan(lf.reconcile(replica, increment, lf.merge_latest(replica, increment)))
    assert len(re.findall(r"\) Window\n", latest)) == 1


def test_latest_shuffles_once_and_passes_closed_rows_by(stored):
    text = plan(lf.merge_latest(*stored))
    assert len(re.findall(r"hashpartitioning\(id#", text)) == 1
    assert text.count(", Partial") == 1 and text.count(", Final") == 1


def test_reconcile_has_no_nested_loops(stored):
    replica, increment = stored
    for dense in (True, False):
        report = lf.reconcile(replica, increment, lf.merge_closed_key(*stored), dense_ids=dense)
        shape = tree(report)
        assert "NestedLoop" not in shape and "Cartesian" not in shape


def test_no_python_in_any_plan(stored):
    replica, increment = stored
    for df in (
        lf.merge_closed_key(replica, increment),
        lf.merge_closed_key_by_subpartition(replica, increment),
        lf.merge_latest(replica, increment),
        lf.rank_versions(replica),
        lf.new_entities(increment, replica),
    ):
        assert not re.search(r"Python|Pandas", tree(df))
