"""Every registered query runs over whole tables, and agrees with its SQL where it has one."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_points

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return str(value)
    return float(value) if isinstance(value, int | float) or hasattr(value, "quantize") else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", sorted(entry_points.queries()))
def test_query(spark, sf, duck, key):
    result = entry_points.queries()[key](spark, sf)
    rows = _rows(result.columns, result.collect())
    assert rows
    sql = entry_points.oracle_sql().get(key)
    if sql is None:
        return
    expected = duck.execute(sql)
    names = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(names)
    assert rows == _rows(names, expected.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
