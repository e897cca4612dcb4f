"""Every registered query against the same question asked in DuckDB, at the smallest scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import compare

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    assert len(got) > 0
    if name in entry.oracle_sql():
        assert compare(got, duck.execute(entry.oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["topic", "key", "value"]
