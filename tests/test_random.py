"""Random small replicas and increments against the merge rules in plain Python."""

import os
import random
from collections import Counter
from datetime import date
from uuid import uuid4

import pytest

import golden
import ledgerfold as lf
from ledgerfold.operators.rank import ORIGIN, candidates

STARTS = [date(2024, 1, 5), date(2024, 1, 31), date(2024, 2, 1), date(2024, 3, 9), None]
ENDS = [golden.OPEN] * 5 + [date(2024, 4, 30), date(2024, 5, 1), date(5999, 12, 15), None]
SEEDS = range(int(os.environ.get("TEST_SEEDS", "1")))
COLUMNS = ("id", "payload", "eff_from_dt", "eff_to_dt")


def rows_of(rng, count):
    keys = [*range(6), None]
    return [
        (rng.choice(keys), rng.choice("abc"), rng.choice(STARTS), rng.choice(ENDS))
        for _ in range(count)
    ]


def is_open(row):
    return row[3] is not None and (row[3].year, row[3].month) == (5999, 12)


def by_closed_key(replica, increment):
    closed = {
        (r[0], r[2])
        for r in increment
        if r[3] is not None and not is_open(r) and None not in (r[0], r[2])
    }
    kept = [r for r in replica if not is_open(r) or (r[0], r[2]) not in closed]
    return Counter(increment + kept)


def ranked(replica, increment):
    bag = [(*r, 0) for r in increment] + [(*r, 1) for r in replica if is_open(r)]

    def newest_first(r):
        start, end = (-d.toordinal() if d else 1 for d in r[2:4])
        return (start, end, r[4], r[1])

    entities = {}
    for row in bag:
        entities.setdefault(row[0], []).append(row)
    return [
        (*row[:4], n)
        for rows in entities.values()
        for n, row in enumerate(sorted(rows, key=newest_first), 1)
    ]


def by_latest(replica, increment):
    kept = [
        r[:4]
        for r in ranked(replica, increment)
        if r[3] is not None and (r[3] != golden.OPEN or r[4] == 1)
    ]
    return Counter(kept + [r for r in replica if not is_open(r)])


@pytest.mark.parametrize("seed", range(6))
def test_random_merges(spark, seed):
    rng = random.Random(seed)
    replica, increment = rows_of(rng, rng.randint(5, 60)), rows_of(rng, rng.randint(5, 60))
    base = lf.with_months(spark.createDataFrame(replica, golden.SCHEMA))
    new = spark.createDataFrame(increment, golden.SCHEMA)

    def bag(df, *more):
        return Counter(tuple(r) for r in df.select(*COLUMNS, *more).collect())

    want = by_closed_key(replica, increment)
    assert bag(lf.merge_closed_key(base, new)) == want
    assert bag(lf.merge_closed_key_by_subpartition(base, new)) == want
    assert bag(lf.merge_latest(base, new)) == by_latest(replica, increment)
    both = candidates(lf.open_slice(base), lf.conform(new, base))
    want = Counter(ranked(replica, increment))
    assert bag(lf.rank_versions(both).drop(ORIGIN), "rn") == want


TARGETS = [
    ("closed_key", "path"),
    ("closed_key_by_subpartition", "path"),
    ("closed_key_by_subpartition", "table"),
    ("latest", "attached"),
]


@pytest.mark.parametrize(("strategy", "kind"), TARGETS, ids=lambda v: v)
@pytest.mark.parametrize("seed", SEEDS)
def test_random_runs_on_storage(spark, tmp_path, strategy, kind, seed):
    rng = random.Random(100 + seed)
    rows = rows_of(rng, 40)
    base = lf.with_months(spark.createDataFrame(rows, golden.SCHEMA))
    if kind == "path":
        target, name = lf.PathReplica(f"{tmp_path}/replica"), None
        lf.stage(base, target.path)
    else:
        name = f"random_{uuid4().hex}"
        path = f"{tmp_path}/table"
        columns = [*COLUMNS, "eff_to_month", "eff_from_month"]
        schema = base.select(*columns).schema
        target = lf.create_replica(spark, name, schema, path, attach=kind == "attached")
        base.select(*columns).write.insertInto(name)
    model = by_latest if strategy == "latest" else by_closed_key
    for run in range(2):
        increment = rows_of(rng, 25)
        spark.createDataFrame(increment, golden.SCHEMA).write.parquet(f"{tmp_path}/incr{run}")
        got = lf.apply_increment(spark, target, f"{tmp_path}/incr{run}", f"{tmp_path}/st", strategy)
        rows = list(model(rows, increment).elements())
        assert Counter(tuple(r) for r in got.select(*COLUMNS).collect()) == Counter(rows)
    if name:
        spark.sql(f"DROP TABLE {name}")
