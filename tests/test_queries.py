"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract
from check_oracle import TABLES, canonical

from tidelog.plans.catalog import all_queries
from tidelog.plans.oracle import all_sql

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def db(small_sf):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small_sf}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, small_sf, name):
    got = canonical(QUERIES[name](spark, small_sf).toArrow())
    assert got == canonical(db.sql(SQL[name]).to_arrow_table())


def test_all_queries_are_registered():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_flagship(spark):
    assert contract.entry(spark).count() > 0
