"""Every registered query against its oracle SQL, on the smallest test tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from lakemart.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS FROM '{path}'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry_module.oracle_sql())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches(spark, duck, name):
    got = entry_module.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    result = duck.execute(entry_module.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    wanted = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in result.fetchall())
    assert sorted(repr(tuple(row)) for row in got.select(*columns).collect()) == wanted


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
