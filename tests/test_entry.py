"""The registered queries against DuckDB, on the smallest tables."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("events", "orders", "lineitem", "documents", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        return f"{value:.12g}" if isinstance(value, float) else repr(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


OWN = [name for name in entry.queries() if not name.startswith("op") and name != "pipeline"]


def test_every_query_has_its_sql():
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert set(OWN) <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", [name for name in entry.queries() if name in entry.oracle_sql()])
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.collect(), df.columns) == comparable(result.fetchall(), columns)


def test_entry(spark):
    first = entry.entry(spark).first()
    assert isinstance(first.ride_date, dt.date | None)


def test_no_event_is_dropped_and_all_kinds_of_customer_occur(spark):
    events = entry._events(spark, SF_DIR)
    assert events.count() == spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    for name, column, kinds in (
        ("customer_segments", "customer_segment", {"frequent", "regular", "occasional"}),
        ("customer_retention", "retention_status", {"active", "lapsing", "churned"}),
    ):
        found = {row[0] for row in entry.queries()[name](spark, SF_DIR).select(column).distinct().collect()}
        assert len(found & kinds) >= 2


def test_ties_give_more_rows_than_drivers(spark):
    queries = entry.queries()
    assert queries["latest_location_ties"](spark, SF_DIR).count() > queries["latest_location"](spark, SF_DIR).count()
