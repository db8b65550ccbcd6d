"""Small files are merged within bounds, rows stay, and counts come from footers."""

import contextlib
import io
import os
from collections import Counter
from datetime import date

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import golden
import ledgerfold as lf
from ledgerfold.operators.bins import dealt, month_name, packed
from ledgerfold.plans import jobs
from ledgerfold.sources.footers import counted_by_footers
from ledgerfold.sources.staging import write_replica
from ledgerfold.sources.targets import files_below, read_files
from test_publish import Crash, Stored, Tabled, _break, bag

START, END, OPEN = date(2024, 1, 5), date(2024, 3, 1), golden.OPEN


def files(path):
    """Names of the data files of each month."""
    made = {}
    for folder, _, names in os.walk(path):
        kept = {n for n in names if n[0] not in "._"}
        if kept and "_ledgerfold" not in folder:
            made[os.path.relpath(folder, path)] = kept
    return made


@given(
    st.dictionaries(
        st.tuples(st.sampled_from("abc"), st.integers(0, 60)).map(lambda t: f"e={t[0]}/s={t[0]}/f{t[1]}"),
        st.integers(0, 200),
    ),
    st.integers(0, 8),
)
def test_bins_hold_small_files_of_one_due_month(sizes, most):
    bins = packed(sizes, file_bytes=200, most_small=most)
    small = Counter(month_name(f) for f, n in sizes.items() if n < 50)
    assert all(sizes[f] < 50 and small[month_name(f)] > most for f in bins)
    months, total, members = {}, Counter(), Counter(bins.values())
    for name, i in bins.items():
        assert months.setdefault(i, month_name(name)) == month_name(name)
        total[i] += sizes[name]
    assert all(n <= 200 for n in total.values()) and all(n > 1 for n in members.values())
    assert sorted(members) == list(range(len(members)))
    # what stays small: one file that was left over, and one bin that is not full
    left = Counter(month_name(f) for f, n in sizes.items() if n < 50 and f not in bins)
    for month, n in small.items():
        part = sum(1 for i, m in months.items() if m == month and total[i] < 50)
        assert n <= most or left[month] + part <= 1


def scattered(spark, path, n=6):
    """Rows of a closed and an open month in ``n`` files each, of one month in a single file."""
    rows = [(i, f"p{i}", START, END if i % 2 else OPEN) for i in range(40)]
    rows += [(100, "q", None, OPEN), (101, "r", START, None), (102, None, date(2023, 1, 1), OPEN)]
    frame = lf.with_months(spark.createDataFrame(rows, golden.SCHEMA))
    frame = frame.repartitionById(n, F.col("id").cast("int") % n)
    write_replica(frame, path, "overwrite")
    return rows


@pytest.fixture
def many(spark, tmp_path):
    made = Stored(spark, tmp_path, increment=[(0, "p0", START, END)])
    made.rows = scattered(spark, made.replica)
    return made


def test_months_that_are_due_get_one_file(spark, many):
    before = files(many.replica)
    got = lf.compact_replica(spark, many.replica, many.staging, run_id="c", most_small=2)
    assert bag(got) == Counter(many.rows)
    after = files(many.replica)
    assert {m: len(f) for m, f in after.items()} == dict.fromkeys(before, 1)
    assert all(after[m] == f for m, f in before.items() if len(f) <= 2)
    assert lf.reconcile_chain(spark, many.replica).filter("NOT ok").isEmpty()
    # nothing is due any more
    lf.compact_replica(spark, many.replica, many.staging, most_small=2)
    assert files(many.replica) == after
    assert bag(lf.undo_run(spark, many.replica, "c")) == Counter(many.rows)
    assert files(many.replica) == before


def test_bins_are_whole_files(spark, many):
    location = many.replica
    names = files_below(spark, location, [n for n in os.listdir(location) if "=" in n])
    month = next(m for m, f in files(location).items() if len(f) > 2)
    inside = sorted(n for n in names if month_name(n) == month)
    bins = {n: i // 3 for i, n in enumerate(inside)}
    rows = read_files(spark, location, many.read().schema, inside)
    got = dealt(rows, bins, lf.ScdSpec()).withColumn("task", F.spark_partition_id())
    assert got.select("task").distinct().count() == max(bins.values()) + 1
    assert bag(got) == bag(rows)
    # a file that the numbers do not name is not lost
    assert bag(dealt(rows, {inside[0]: 0, inside[1]: 0}, lf.ScdSpec())) == bag(rows)


def test_files_stay_bounded_over_many_runs(spark, tmp_path):
    other = (9, "z", date(2023, 5, 5), OPEN)
    stored = Stored(spark, tmp_path, [(0, "a", START, OPEN), other])
    quiet = {m: f for m, f in files(stored.replica).items() if "2023-05-31" in m}
    for i in range(1, 10):
        rows = [(i, "a", START, END), (50 + i, "b", START, OPEN)]
        spark.createDataFrame(rows, golden.SCHEMA).coalesce(1).write.mode("overwrite").parquet(stored.increment)
        stored.apply("closed_key_by_file", run_id=f"day-{i}", most_small=3)
        held = files(stored.replica)
        assert max(len(f) for f in held.values()) <= 5
    assert len(held) == 3 and {m: held[m] for m in quiet} == quiet
    assert stored.read().count() == 20
    assert lf.reconcile_chain(spark, stored.replica).filter("NOT ok").isEmpty()


@pytest.mark.parametrize("where", ["while staging", "while merging", "after the append", "before the open rows"])
def test_a_broken_merge_is_finished(where, spark, many, monkeypatch):
    target = lf.PathReplica(many.replica)
    want = Counter(many.rows) - Counter([(0, "p0", START, OPEN)]) + Counter([(0, "p0", START, END)])
    with monkeypatch.context() as patch:
        if where == "while merging":
            patch.setattr(jobs, "stage_more", lambda *args: (_ for _ in ()).throw(Crash()))
        else:
            _break(patch, where, target)
        with pytest.raises(Crash):
            many.apply("closed_key_by_file", run_id="one", most_small=2)
    lf.resume_run(spark, target, many.staging, "one")
    if where.startswith("while"):
        assert bag(many.read()) == Counter(many.rows)
        many.apply("closed_key_by_file", run_id="two", most_small=2)
    assert bag(many.read()) == want
    assert lf.reconcile_chain(spark, many.replica).filter("NOT ok").isEmpty()


@pytest.mark.parametrize("attach", [False, True])
def test_tables_are_compacted_and_undone(attach, spark, tmp_path):
    made = Tabled(spark, tmp_path, attach)
    try:
        for run in ("one", "two", "three"):
            made.apply(run_id=run)
        once, location = bag(made.read()), f"{tmp_path}/table"
        before = files(location)
        assert max(len(f) for f in before.values()) > 2
        opened = {r[0] for r in lf.open_slice(made.read()).select("_metadata.file_path").collect()}
        got = lf.compact_replica(spark, made.replica, made.staging, run_id="c", most_small=1)
        assert bag(got) == once
        closed = {m: f for m, f in files(location).items() if "to_month=5999" not in m}
        assert closed and all(len(f) == 1 for f in closed.values())
        if attach:
            again = lf.open_slice(made.read()).select("_metadata.file_path").collect()
            assert {r[0] for r in again} == opened
        assert lf.reconcile_chain(spark, made.replica).filter("NOT ok").isEmpty()
        assert bag(lf.undo_run(spark, made.replica, "c")) == once
        assert files(location) == before
        made.apply(run_id="four", most_small=1)
        assert lf.reconcile_chain(spark, made.replica).filter("NOT ok").isEmpty()
        assert bag(lf.undo_run(spark, made.replica, "four")) == once
    finally:
        spark.sql(f"DROP TABLE {made.name}")


def test_counts_read_no_column(spark, many):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        counted_by_footers(spark, many.replica).explain("formatted")
    text = out.getvalue()
    assert "PushedAggregation: [COUNT(*)]" in text
    assert "PushedGroupBy: [eff_to_month, eff_from_month]" in text
    assert "payload" not in text and "Filter" not in text
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_footers_count_like_rows(spark, many, tmp_path):
    months = ("eff_to_month", "eff_from_month")
    want = many.read().groupBy(*months).count()
    assert Counter(lf.footer_counts(spark, many.replica).collect()) == Counter(want.collect())
    write_replica(many.read().limit(0), f"{tmp_path}/none", "errorifexists")
    assert lf.footer_counts(spark, f"{tmp_path}/none").isEmpty()


def test_the_report_from_footers_is_the_same(spark, many):
    base, before = many.read(), lf.footer_counts(spark, many.replica)
    increment = spark.createDataFrame(
        [(0, "p0", START, END), (900, "n", START, OPEN), (901, "n", START, OPEN)], golden.SCHEMA
    )
    want = lf.reconcile(base, increment, base).collect()
    got = lf.reconcile_counts(before, increment, before, keys=base).collect()
    assert Counter(got) == Counter(want)
    dense = lf.reconcile(base, increment, base, dense_ids=True).collect()
    assert Counter(lf.reconcile_counts(before, increment, before).collect()) == Counter(dense)
