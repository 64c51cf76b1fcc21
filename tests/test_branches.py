"""The views of these rows reach the branches that they stand for (counted by the twins)."""

import duckdb
import pytest

from railtrace.plans.oracle import ORACLE_SQL
from tools.check_oracle import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_defaults_and_null_factors_are_reached(con):
    rows = {r[3]: [None if x is None else float(x) for x in r[:3]] for r in con.execute(ORACLE_SQL["factor_defaults"]).fetchall()}
    assert rows["night train"][0] == 14 and rows["plane"][1] == 144 and rows["car"][2] == 132
    assert rows["night train"][1] != 144 and rows["car"][0] != 14
    assert rows["numbers"] == [None, None, None]


def test_blank_names_are_reached(con):
    flt1 = con.execute(f"SELECT sum(flt1), count(*) FILTER (WHERE flt1 > 0) FROM ({ORACLE_SQL['feed_ledger_blank']})").fetchone()
    assert flt1[0] > 100 and flt1[1] == 10


def test_modes_repeat_so_that_sheet_order_decides(con):
    many = con.execute(f"SELECT count(*) FROM ({ORACLE_SQL['first_factors_files']}) WHERE n > 1").fetchone()[0]
    assert many >= 10
