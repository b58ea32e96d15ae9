"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from attestal.plans.catalog import QUERIES
from attestal.plans.oracle import ORACLE

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, SF)
    cursor = tables.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr(tuple(row[names.index(c)] for c in sorted(names))) for row in cursor.fetchall())
    got = sorted(repr(tuple(row[c] for c in sorted(names))) for row in df.collect())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
