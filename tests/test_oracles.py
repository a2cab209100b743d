"""Every registered query against its SQL in DuckDB, and the entry points."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from airscan.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return connection


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    return [columns[i] for i in order], sorted(repr([plain(row[i]) for i in order]) for row in rows)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert sum(row["count"] for row in rows) == 205 and len(rows) == 16


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    result = entry.queries()[name](spark, SF_DIR)
    cursor = db.execute(entry.oracle_sql()[name])
    want = table([column[0] for column in cursor.description], cursor.fetchall())
    assert table(result.columns, result.collect()) == want
