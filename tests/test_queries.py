"""Every query against its SQL on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.oracle import ORACLES
from catalog.queries import QUERIES
from tools.compare import TABLES, canonical

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, db, name):
    frame = entry.queries()[name](spark, FOLDER)
    result = db.execute(ORACLES[name])
    theirs = canonical([c[0] for c in result.description], result.fetchall())
    assert canonical(frame.columns, frame.collect()) == theirs
