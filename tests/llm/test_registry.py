"""Every registered query: against its SQL, over edge rows, and over empty tables."""

import duckdb
import pytest

import __spark_entry__
from ordermart.llm.registry import ORACLE, QUERIES

ROWS_PER_INPUT = [n for n in QUERIES if n.split("_")[0] in ("op2", "op4", "op5", "op6", "op7", "op8", "op9", "op10", "op12", "op13")]


def plain(rows, columns):
    return sorted(tuple(str(r[c]) for c in columns) for r in rows)


def test_entry_has_them_all():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("place", ["sf", "edge"])
def test_against_sql(name, place, spark, sf_dir, edge_dir):
    folder, glob = (sf_dir, "") if place == "sf" else (edge_dir, "/*.parquet")
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet{glob}'")
    cursor = connection.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    result = QUERIES[name](spark, folder)
    assert sorted(result.columns) == sorted(columns)
    expected = [dict(zip(columns, row, strict=True)) for row in cursor.fetchall()]
    if place == "edge" and name.startswith("op10"):
        # Of rows that repeat an id, SQL keeps all; the operator keeps one.
        columns = [c for c in columns if c != "kept"]
    assert plain(result.collect(), columns) == plain(expected, columns)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_edge_rows(name, spark, edge_dir, edge_rows, edge_vectors):
    rows = QUERIES[name](spark, edge_dir).collect()
    if name in ROWS_PER_INPUT:
        assert len(rows) == {"op7": 8, "op13": len(edge_vectors)}.get(name.split("_")[0], len(edge_rows))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(name, spark, empty_dir):
    assert QUERIES[name](spark, empty_dir).collect() == []
