"""Every registered query against its SQL on the same Parquet files."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as se

TABLES = ("orders", "lineitem")


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else round(value, 6)
        return value

    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(se.merge_queries()) == set(se.merge_sql())
    assert set(se.merge_queries()) <= set(se.queries())
    assert set(se.merge_sql()) <= set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", sorted(se.merge_queries()))
def test_query_equals_sql(name, spark, sf_dir, oracle):
    got = se.queries()[name](spark, sf_dir)
    want = oracle.execute(se.oracle_sql()[name])
    names = [d[0] for d in want.description]
    rows = want.fetchall()
    assert sorted(got.columns) == sorted(names)
    assert rows
    assert _bag([tuple(r) for r in got.collect()], got.columns) == _bag(rows, names)


def test_entry_has_rows(spark):
    assert se.entry(spark).count() > 0
