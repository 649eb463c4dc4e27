"""Every query against its SQL on DuckDB, over whole tables."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_file
from opsframe.plans import oracles, warehouse

FOLDER = os.environ.get("OPSFRAME_TEST_TABLES", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    return float(value) if isinstance(value, Decimal) else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(body, key=repr)


def test_every_oracle_has_a_query():
    assert set(entry_file.oracle_sql()) <= set(entry_file.queries())
    assert set(oracles.ORACLES) == set(warehouse.QUERIES)


@pytest.mark.parametrize("name", sorted(entry_file.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = entry_file.queries()[name](spark, FOLDER)
    actual = table(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = duck.execute(entry_file.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected = table(columns, cursor.fetchall())
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1])
    assert actual[1] == expected[1]


def test_entry(spark):
    assert entry_file.entry(spark).count() == 3
