"""Every registered query against its SQL on an independent engine, by column name, type and value."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from goldpan.plans import registry

QUERIES = {name: query for name, query in contract.queries().items() if name in registry.queries()}
ORACLE = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SAME_TYPE = {"string": "VARCHAR", "int": "INTEGER"}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


def key(value):
    return (value is None, str(type(value)), value if not isinstance(value, (dict, list)) else str(value))


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([row[i] for i in order] for row in rows), key=lambda row: [key(v) for v in row])


def types_by_name(columns, types):
    return {c: SAME_TYPE.get(t, t.upper()) for c, t in zip(columns, types)}


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, con, folder, name):
    frame = QUERIES[name](spark, folder)
    found = [tuple(row) for row in frame.collect()]
    result = con.sql(ORACLE[name])
    expected = result.fetchall()
    assert sorted(frame.columns) == sorted(result.columns)
    assert types_by_name(frame.columns, [t for _, t in frame.dtypes]) == types_by_name(
        result.columns, [str(t) for t in result.types]
    )
    assert len(found) > 0
    assert rows_by_name(frame.columns, found) == rows_by_name(result.columns, expected)
    for value in found[0]:
        assert value is None or isinstance(value, (str, int, float, bool, Decimal, dt.date))


def test_whole_answers_match_sql_at_the_smallest_scale(spark):
    small = "/root/testdata/sf0.001"
    con = duck(small)
    different = []
    for name, query in QUERIES.items():
        frame, result = query(spark, small), con.sql(ORACLE[name])
        found = rows_by_name(frame.columns, [tuple(r) for r in frame.collect()])
        if found != rows_by_name(result.columns, result.fetchall()):
            different.append(name)
    assert different == []


@pytest.mark.parametrize("name", ["gold_state", "gold_class", "gold_kpis", "region_late", "benchmark_by_model"])
def test_gold_matches_sql_at_a_larger_scale(spark, name):
    large = "/root/testdata/sf0.1"
    frame, result = QUERIES[name](spark, large), duck(large).sql(ORACLE[name])
    found = rows_by_name(frame.columns, [tuple(r) for r in frame.collect()])
    assert found == rows_by_name(result.columns, result.fetchall())
