"""Every registered query against its SQL in DuckDB on the smallest data."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_oracle import compare  # noqa: E402
from tableport.queries import ORACLES, QUERIES  # noqa: E402
from tableport.queries.common import TABLES  # noqa: E402

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{ROOT}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, name, ROOT).startswith("ok")


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == len(TABLES) and all(r["content_equal"] for r in rows)
