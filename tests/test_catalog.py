"""Registered queries against their SQL in DuckDB, on the smallest of the supplied tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from tidemark.catalog import SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = ["customer", "events", "lineitem", "orders", "part"]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")

# One query per family; the whole catalog runs in the driver's own comparison.
NAMES = [
    "purchase_stats_asof",
    "backfill_daily",
    "labels_next_window",
    "pit_join",
    "pit_join_split_entities",
    "latest_values_map",
    "upsert_changes",
    "integrity_checks",
    "quality_checks",
    "drift_checks",
    "precision_at_recall",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def as_text(frame):
    def cell(value):
        if pd.isna(value):
            return "null"
        return f"{value:.6f}" if isinstance(value, float) else str(value)

    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(cell(value) for value in row) for row in ordered.itertuples(index=False))


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    found = entry_points.queries()[name](spark, FOLDER).toPandas()
    expected = duck.execute(entry_points.oracle_sql()[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert as_text(found) == as_text(expected)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_is_understood(duck, name):
    """Every statement, also of the queries that are too slow to run here."""
    assert duck.execute(f"EXPLAIN {SQL[name]}").fetchall()


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
