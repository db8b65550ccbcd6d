"""One entity, version or group of copies holding a third of all rows."""

from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import golden
import ledgerfold as lf
from ledgerfold.operators import rank
from ledgerfold.operators.bags import difference
from ledgerfold.operators.rank import candidates

DAY = date(2020, 1, 1)


def _rows(kind, total=3_000):
    """A third of the rows hot in the way of ``kind``, the others with few versions."""
    out = []
    for i in range(total):
        start, end, payload = DAY + timedelta(days=i % 700), golden.OPEN, f"p{i % 97}"
        if i % 5 == 0:
            end = start + timedelta(days=30)
        key = i % 400
        if i % 3 == 0:
            key = None if kind == "null entity" else 7
            if kind == "version":
                start, end = DAY, golden.OPEN
            if kind == "copies":
                start, end, payload = DAY, golden.OPEN, "same"
        out.append((key, payload, start, end))
    return out


KINDS = ("entity", "null entity", "version", "copies")


@pytest.fixture(scope="module", params=KINDS)
def hot(request, spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('hot')}/rows"
    rows = spark.createDataFrame(_rows(request.param), golden.SCHEMA).repartition(8)
    rows.write.parquet(path)
    return request.param, lf.with_months(spark.read.parquet(path))


def bag(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def _ranked(rows):
    """Rank by sorting on the driver."""

    def newest_first(r):
        return (-r[2].toordinal(), -r[3].toordinal(), r[1])

    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    return Counter(
        (*r, n) for g in groups.values() for n, r in enumerate(sorted(g, key=newest_first), 1)
    )


def test_rank_of_hot_entities(hot):
    kind, df = hot
    ranked = lf.rank_versions(df)
    got = ranked.select("id", "payload", "eff_from_dt", "eff_to_dt", "rn").collect()
    assert Counter(map(tuple, got)) == _ranked(_rows(kind))


def test_hot_ranks_are_spread(hot, spark, monkeypatch):
    _, df = hot
    # so few rows would be one block otherwise
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    seen = []
    keep = rank.checkpointed

    def watched(blocks):
        seen.append(keep(blocks))
        return seen[-1]

    monkeypatch.setattr(rank, "checkpointed", watched)
    try:
        lf.rank_versions(df).count()
    finally:
        spark.conf.unset(coalesce)
    sizes = [r["count"] for r in seen[-1].groupBy("id", "__block").count().collect()]
    assert sum(sizes) >= 1_000
    assert max(sizes) < sum(sizes) / 3


def test_latest_of_hot_entities(hot, spark):
    kind, df = hot
    empty = spark.createDataFrame([], golden.SCHEMA)
    # closed rows of the replica stay out of the ranking
    rows = _rows(kind)
    want = Counter(r for r in rows if r[3] != golden.OPEN)
    open_rows = [r for r in rows if r[3] == golden.OPEN]
    want += Counter(row[:4] for row in _ranked(open_rows) if row[4] == 1)
    got = lf.merge_latest(df, empty).select("id", "payload", "eff_from_dt", "eff_to_dt").collect()
    assert Counter(map(tuple, got)) == want


def test_latest_keeps_one_row_per_entity_before_the_shuffle(hot):
    plan = plan_of(lf.latest_open(candidates(lf.open_slice(hot[1]), hot[1])))
    partial, shuffle = plan.index("Partial"), plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan
    assert shuffle < partial, "the partial limit has to sit below the exchange"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.files.openCostInBytes": "128MB",
}


@pytest.fixture
def small_limits(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("chunk", [7, 1_000_000])
def test_difference_of_bags_with_many_copies(hot, chunk):
    _, df = hot
    some = df.filter("id is null or id = 7 or payload = 'p3'").limit(333)
    got = difference(df, some, chunk)
    assert got.columns == df.columns
    assert bag(got) == bag(df) - bag(some)
    assert bag(difference(some, df, chunk)) == Counter()


# dates spread the versions of an entity, and so few copies compress to nothing
@pytest.mark.parametrize("hot", ["version"], indirect=True)
def test_the_join_splits_a_hot_version(hot, spark, small_limits):
    _, df = hot
    closing = spark.createDataFrame([(5, "x", DAY, DAY)] * 500, golden.SCHEMA)
    kept = lf.unclosed(lf.open_slice(df), lf.closed_keys(closing))
    rows = kept.collect()
    assert "SortMergeJoin(skew=true)" in plan_of(kept)
    other = lf.open_slice(df).filter("not (id <=> 5 and eff_from_dt = date'2020-01-01')")
    assert len(rows) == other.count()


def test_frequent_closed_keys_shrink_before_the_shuffle(hot, spark, small_limits):
    closing = spark.createDataFrame([(7, "x", DAY, DAY)] * 5_000, golden.SCHEMA).repartition(4)
    plan = plan_of(lf.unclosed(lf.open_slice(hot[1]), lf.closed_keys(closing)))
    keys = plan[plan.index("HashAggregate") :]
    assert keys.count("HashAggregate(keys=[id") == 2
    assert lf.closed_keys(closing).distinct().count() == 1


@pytest.mark.parametrize("hot", ["entity", "null entity", "version"], indirect=True)
def test_new_entities_split_a_hot_entity(hot, spark, small_limits):
    _, df = hot
    base = spark.createDataFrame([(1, "x", DAY, golden.OPEN)], golden.SCHEMA)
    new = lf.new_entities(df, base)
    rows = new.collect()
    assert "SortMergeJoin(skew=true)" in plan_of(new)
    assert len(rows) == df.filter("not (id <=> 1)").count()


def test_a_large_month_is_written_by_many_tasks(spark, tmp_path, small_limits):
    rows = spark.range(0, 60_000, numPartitions=16).select(
        F.col("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        F.lit(DAY).alias("eff_from_dt"),
        F.lit(golden.OPEN).alias("eff_to_dt"),
    )
    path = tmp_path / "replica"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512KB")
    lf.stage(lf.with_months(rows), str(path))
    month = path / "eff_to_month=5999-12-31" / "eff_from_month=2020-01-31"
    assert len(list(month.glob("*.parquet"))) > 2
    assert spark.read.parquet(str(path)).count() == 60_000


def test_few_files_for_many_months(spark, tmp_path):
    rows = spark.range(0, 20_000, numPartitions=16).select(
        F.col("id"),
        F.lit("p").alias("payload"),
        F.date_add(F.lit(DAY), (F.col("id") % 300).cast("int")).alias("eff_from_dt"),
        F.lit(golden.OPEN).alias("eff_to_dt"),
    )
    path = tmp_path / "replica"
    lf.stage(lf.with_months(rows), str(path))
    months = spark.read.parquet(str(path)).select("eff_from_month").distinct().count()
    assert len(list(path.glob("*/*/*.parquet"))) == months == 10
