"""The key audit: hashes first, exact keys where a hash is seen twice."""

import pytest
from pyspark.sql import functions as F

from railtrace.sinks import manifest as M


def data(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (None, "x"), (None, "x"), (2, None), (2, None), (2, None), (3, "1:z")], "k int, s string")
    b = spark.range(1000).selectExpr("id % 990 AS k", "'a' AS s")
    hot = spark.range(6000).selectExpr("if(id < 2000, 0, id) AS k", "'h' AS s")  # one key holds a third
    split = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("1:a", ""), ("1", "a")], "k string, s string")
    empty = a.limit(0)
    return {"a": (a, ["k", "s"]), "b": (b, ["k"]), "hot": (hot, ["k"]), "split": (split, ["k", "s"]), "empty": (empty, ["k"])}


EXPECTED = {"a": (8, 2), "b": (1000, 10), "hot": (6000, 1), "split": (4, 0), "empty": (0, 0)}


@pytest.mark.parametrize("collide", [False, True])
def test_counts_hold_when_hashes_collide(spark, monkeypatch, collide):
    if collide:
        monkeypatch.setattr(M, "_hash", lambda keys: F.lit(7).cast("long"))
    got = {r.dataset: (r.rows, r.duplicate_keys) for r in M.dataset_audit(data(spark)).collect()}
    assert got == EXPECTED


def test_a_key_is_shuffled_as_its_hash(spark, tmp_path):
    """The first aggregate carries no key text."""
    spark.range(100).selectExpr("concat('key ', id) AS k").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    plan = M.dataset_audit({"t": (t, ["k"]), "u": (t, ["k"])})._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert any("hash#" in x for x in lines) and "Cartesian" not in plan and "Python" not in plan
