"""Every registered query against its SQL in DuckDB: same columns, same rows as multisets."""

import os
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
STARS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for star in STARS:
        connection.execute(f"create view {star} as select * from '{SF_DIR}/{star}.parquet'")
    return connection


# Queries of the training-data subpackage have tests of their own.
NAMES = [name for name in entry.queries() if name != "pipeline" and not re.match(r"op\d+_", name)]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    result = entry.queries()[name](spark, SF_DIR)
    expected = duck.execute(entry.oracle_sql()[name])
    columns = sorted(result.columns)
    assert columns == sorted(c[0] for c in expected.description)
    order = [[c[0] for c in expected.description].index(column) for column in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    ours = Counter(tuple(row) for row in result.select(columns).collect())
    assert sum(theirs.values()) > 0
    assert ours == theirs


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()
