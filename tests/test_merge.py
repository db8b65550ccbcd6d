"""Merge rules on the golden rows, and properties on the scenario data."""

from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import golden
import ledgerfold as lf
import scenarios as sc  # noqa: E402

COLUMNS = ("id", "payload", "eff_from_dt", "eff_to_dt")


def bag(df, columns=COLUMNS):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture(scope="module")
def replica(spark):
    return lf.with_months(spark.createDataFrame(golden.REPLICA, golden.SCHEMA))


@pytest.fixture(scope="module")
def increment(spark):
    return spark.createDataFrame(golden.INCREMENT, golden.SCHEMA)


@pytest.mark.parametrize(
    "merge", [lf.merge_closed_key, lf.merge_closed_key_by_subpartition], ids=lambda m: m.__name__
)
def test_closed_key_rules(merge, replica, increment):
    merged = merge(replica, increment)
    assert bag(merged) == Counter(golden.expected_closed_key())
    assert merged.columns == replica.columns


def test_closed_key_partitions(replica, increment):
    merged = lf.merge_closed_key(replica, increment)
    got = {
        (str(r[0]), str(r[1]))
        for r in merged.select("eff_to_month", "eff_from_month").distinct().collect()
    }
    want = {
        ("2024-05-31", m) for m in ("2024-01-31", "2024-02-29", "2024-04-30", "2024-05-31")
    }
    want |= {("2024-06-30", "2024-05-31"), ("None", "2024-06-30")}
    want |= {
        ("5999-12-31", m)
        for m in ("2024-01-31", "2024-02-29", "2024-03-31", "2024-05-31", "2024-06-30")
    }
    assert got == want


def test_latest_rules(replica, increment):
    merged = lf.merge_latest(replica, increment)
    assert bag(merged) == Counter(golden.expected_latest())
    assert merged.columns == replica.columns


def test_latest_tie_takes_the_increment_row(spark, replica):
    again = spark.createDataFrame(
        [(8, "newer", date(2024, 2, 7), golden.OPEN)], golden.SCHEMA
    )
    rows = lf.merge_latest(replica, again).filter("id = 8").collect()
    assert [r.payload for r in rows] == ["newer"]


def test_latest_null_entities_are_one_group(spark, replica):
    two = spark.createDataFrame(
        [
            (None, "n1", date(2024, 3, 1), golden.OPEN),
            (None, "n2", date(2024, 3, 2), golden.OPEN),
        ],
        golden.SCHEMA,
    )
    rows = lf.merge_latest(replica, two).filter("id is null").collect()
    assert [r.payload for r in rows] == ["n2"]


def test_same_increment_twice(replica, increment):
    first = lf.merge_closed_key(replica, increment)
    assert lf.merge_closed_key(first, increment).count() == 43
    first = lf.merge_latest(replica, increment)
    assert lf.merge_latest(first, increment).count() == 29


def test_a_replica_row_without_an_end_stays(spark, increment):
    rows = [*golden.REPLICA, (99, "rX", date(2024, 1, 1), None)]
    replica = lf.with_months(spark.createDataFrame(rows, golden.SCHEMA))
    for merge in (lf.merge_closed_key, lf.merge_closed_key_by_subpartition, lf.merge_latest):
        assert merge(replica, increment).filter("id = 99").count() == 1


def test_an_open_row_without_a_start_stays(spark, increment):
    rows = [*golden.REPLICA, (99, "rX", None, golden.OPEN)]
    replica = lf.with_months(spark.createDataFrame(rows, golden.SCHEMA))
    for merge in (lf.merge_closed_key, lf.merge_closed_key_by_subpartition):
        assert merge(replica, increment).filter("id = 99").count() == 1


def test_a_map_payload_passes_through(spark):
    schema = "id bigint, tags map<string,int>, eff_from_dt date, eff_to_dt date"
    base = lf.with_months(
        spark.createDataFrame([(1, {"a": 1}, date(2024, 1, 1), golden.OPEN)], schema)
    )
    new = spark.createDataFrame([(1, {"a": 2}, date(2024, 2, 1), golden.OPEN)], schema)
    assert lf.merge_closed_key(base, new).count() == 2
    assert [r.tags for r in lf.merge_latest(base, new).collect()] == [{"a": 2}]


def test_odd_column_names_pass_through(spark):
    schema = "id bigint, `a.b c` string, eff_from_dt date, eff_to_dt date"
    base = lf.with_months(
        spark.createDataFrame([(1, "x", date(2024, 1, 1), golden.OPEN)], schema)
    )
    new = spark.createDataFrame([(1, "y", date(2024, 2, 1), golden.OPEN)], schema)
    for merge in (lf.merge_closed_key, lf.merge_closed_key_by_subpartition, lf.merge_latest):
        assert merge(base, new).columns == base.columns


def test_other_names_in_the_spec(spark):
    spec = lf.ScdSpec("k", "since", "till", "till_m", "since_m", date(9999, 12, 31))
    schema = "k bigint, v string, since date, till date"
    end = spec.open_date
    base = lf.with_months(spark.createDataFrame([(1, "a", date(2024, 1, 5), end)], schema), spec)
    new = spark.createDataFrame(
        [(1, "a", date(2024, 1, 5), date(2024, 2, 1)), (1, "b", date(2024, 2, 2), end)], schema
    )
    for merge in (lf.merge_closed_key, lf.merge_closed_key_by_subpartition, lf.merge_latest):
        rows = merge(base, new, spec).select("v", "till").collect()
        assert Counter(map(tuple, rows)) == Counter([("a", date(2024, 2, 1)), ("b", end)])


# --- the increment's shape --------------------------------------------------


def test_conform_orders_casts_and_drops(spark, replica):
    raw = spark.createDataFrame(
        [("x", "2024-05-31 10:00:00", "2024-01-10", "p", "7")],
        "extra string, eff_to_dt string, eff_from_dt string, payload string, id string",
    ).withColumn("eff_to_dt", F.col("eff_to_dt").cast("timestamp_ntz"))
    shaped = lf.conform(raw, replica)
    assert [(f.name, f.dataType) for f in shaped.schema] == [
        (f.name, f.dataType) for f in replica.schema
    ]
    row = shaped.first()
    assert (row.id, row.eff_to_dt, row.eff_to_month) == (7, date(2024, 5, 31), date(2024, 5, 31))


def test_conform_takes_names_of_any_case(spark, replica, increment):
    upper = increment.select(*[F.col(c).alias(c.upper()) for c in increment.columns])
    assert same(lf.conform(upper, replica), lf.conform(increment, replica))
    assert lf.conform(upper, replica).columns == replica.columns


def test_conform_derives_the_months_anew(replica, increment):
    wrong = lf.with_months(increment).withColumn("eff_to_month", F.lit(date(2000, 1, 31)))
    assert same(lf.conform(wrong, replica), lf.conform(increment, replica))


def test_conform_names_missing_columns(spark, replica, increment):
    with pytest.raises(ValueError, match="payload"):
        lf.conform(increment.drop("payload"), replica)


def test_rejects_are_split_off(spark):
    raw = spark.createDataFrame(
        [(1, "2024-01-01", "5999-12-31"), (2, "2024-13-01", "5999-12-31"), (3, "2024-01-01", None)],
        "id bigint, eff_from_dt string, eff_to_dt string",
    )
    good, bad = lf.split_rejects(raw)
    assert [r.id for r in good.collect()] == [1]
    assert sorted(r.id for r in bad.collect()) == [2, 3]


def test_closed_keys_follow_the_month_not_the_day(spark):
    first, last = date(5999, 11, 29), date(6000, 1, 2)
    days = [first + timedelta(days=n) for n in range((last - first).days + 1)]
    rows = spark.createDataFrame(
        [(i, "p", date(2024, 1, 1), d) for i, d in enumerate(days)], golden.SCHEMA
    )
    by_month = lf.with_months(rows).filter("eff_to_month <> date'5999-12-31'").select("id")
    assert bag(lf.closed_keys(rows), ["id"]) == bag(by_month, ["id"])


# --- properties on the scenario data ----------------------------------------


def test_strategies_agree_on_a_clean_increment(spark, sf_dir):
    base, clean = sc.orders_replica(spark, sf_dir), sc.orders_increment(spark, sf_dir, dirty=False)
    assert same(lf.merge_closed_key(base, clean), lf.merge_latest(base, clean))


def test_subpartition_form_equals_the_plain_join(spark, sf_dir):
    base, new = sc.orders_replica(spark, sf_dir), sc.orders_increment(spark, sf_dir)
    assert same(lf.merge_closed_key(base, new), lf.merge_closed_key_by_subpartition(base, new))


def test_closed_versions_are_never_lost(spark, sf_dir):
    base, new = sc.orders_replica(spark, sf_dir), sc.orders_increment(spark, sf_dir)
    first = lf.merge_closed_key(base, new)
    for merge in (lf.merge_closed_key, lf.merge_latest):
        again = lf.closed_slice(merge(first, new))
        assert lf.closed_slice(first).exceptAll(again).isEmpty()


def counted_by_key_class(spark, sf_dir, dirty):
    """The increment of the survey's count table: classes by remainder of the key."""
    base = sc.orders_replica(spark, sf_dir)
    rows = base.drop("eff_from_month", "eff_to_month")
    total = rows.count()
    closing = {"eff_to_dt": F.lit(date(2005, 5, 31))}
    successor = {
        "status": F.lit("U"),
        "amount": F.col("amount") + 1,
        "eff_from_dt": F.lit(date(2005, 6, 1)),
    }
    kinds = [
        ("id % 10 = 0", closing),
        ("id % 10 = 0", successor),
        (
            "id % 20 = 7",
            {
                "id": F.col("id") + total,
                "status": F.lit("N"),
                "eff_from_dt": F.lit(date(2005, 6, 2)),
            },
        ),
    ]
    if dirty:
        kinds += [
            ("id % 10 = 3", closing),
            ("id % 10 = 4", successor),
            ("id % 100 = 5", {"status": F.lit("L"), "eff_from_dt": F.lit(date(1990, 1, 15))}),
            ("id % 100 = 8", {}),
        ]
    parts = [rows.filter(test).withColumns(new) if new else rows.filter(test) for test, new in kinds]
    increment = parts[0]
    for part in parts[1:]:
        increment = increment.unionByName(part)
    return base, increment


@pytest.mark.parametrize(
    ("dirty", "rows", "closed_key", "latest", "open_by_key", "open_latest", "closed"),
    [
        (False, 3_750, 17_250, 17_250, 15_750, 15_750, 1_500),
        (True, 7_050, 19_050, 18_750, 16_050, 15_750, 3_000),
    ],
    ids=["clean", "dirty"],
)
def test_survey_counts(
    spark, sf_dir, dirty, rows, closed_key, latest, open_by_key, open_latest, closed
):
    base, increment = counted_by_key_class(spark, sf_dir, dirty)
    by_key, by_rank = lf.merge_closed_key(base, increment), lf.merge_latest(base, increment)
    assert (increment.count(), by_key.count(), by_rank.count()) == (rows, closed_key, latest)
    assert lf.open_slice(by_key).count() == open_by_key
    assert lf.open_slice(by_rank).count() == open_latest
    assert lf.closed_slice(by_key).count() == lf.closed_slice(by_rank).count() == closed
    report = {r.check: r for r in lf.reconcile(base, increment, by_rank, dense_ids=True).collect()}
    assert (report["open"].expected, report["closed"].expected) == (15_750, closed)
    assert report["open"].ok and report["closed"].ok
