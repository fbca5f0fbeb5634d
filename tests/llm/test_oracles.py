"""Every query with SQL equals it over the whole tables."""

import glob
import os

import duckdb
import pytest
from compare import compare

from meterlake.llm import queries as Q


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_equals_oracle(spark, con, sf_dir, name):
    assert compare(Q.QUERIES[name](spark, sf_dir), con, Q.ORACLES[name]) == []


def test_registered():
    import __spark_entry__ as e

    assert Q.QUERIES.keys() | {"pipeline"} <= e.queries().keys()
    assert Q.ORACLES.keys() <= e.oracle_sql().keys()
