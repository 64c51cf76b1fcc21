"""Every registered query against its DuckDB oracle (the driver's check),
at sf0.001: row count, column names, order-insensitive value hash."""

import duckdb
import pytest

import __spark_entry__ as E
from railtrace.plans.oracle import ORACLE_SQL
from railtrace.plans.queries import QUERIES
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE_SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["origin", "destination", "origin_country", "destination_country", "distance_km", "co2_savings_kg"]
    assert df.count() >= 0
