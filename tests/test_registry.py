"""Every registered query against its SQL in DuckDB, over the whole small test tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
from small_data import SMALL_DATA
from jobstrata.plans import registry
from jobstrata.plans.standin import TABLES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{SMALL_DATA}/{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_names_agree():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SMALL_DATA)
    columns = sorted(df.columns)
    got = Counter(tuple(row) for row in df.select(*columns).collect())
    result = duck.execute(registry.ORACLE[name])
    assert sorted(c[0] for c in result.description) == columns
    order = [[c[0] for c in result.description].index(name) for name in columns]
    want = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    assert got and got == want


def test_entry(spark):
    assert entry_point.entry(spark).columns[0] == "posting_year"
