"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

from ordermart.plans.oracle import oracle
from ordermart.plans.queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
ORACLE = oracle()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    return "~" if value is None else repr(value) if isinstance(value, float) else str(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    result = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    expected = sorted(tuple(plain(v) for v in row) for row in cursor.fetchall())
    actual = sorted(tuple(plain(row[c]) for c in columns) for row in result.collect())
    assert len(actual) == len(expected)
    assert actual == expected
