"""Every operator query that SQL can express, against its DuckDB twin on the smallest tables."""

import os

import duckdb
import pytest

from railtrace.llm.oracle import ORACLE_SQL
from railtrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(SF, name)}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_twin(spark, duck, name):
    ours = QUERIES[name](spark, SF)
    theirs = duck.sql(ORACLE_SQL[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    a = sorted((tuple(r[c] for c in columns) for r in ours.collect()), key=repr)
    at = [theirs.columns.index(c) for c in columns]
    assert a == sorted((tuple(r[i] for i in at) for r in theirs.fetchall()), key=repr)
