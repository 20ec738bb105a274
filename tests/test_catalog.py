"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, rows_of
from strata.plans import cases, catalog, oracle
from tests.helpers import SAMPLE

QUERIES, ORACLE = catalog.registered(), oracle.oracle_sql() | cases.TWINS


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SAMPLE}/{name}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, db, name):
    df = QUERIES[name](spark, SAMPLE)
    result = db.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, result.fetchall())


def test_the_entry_offers_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
