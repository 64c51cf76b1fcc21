"""Plan checks: no Python in the extraction, no window sort over
stop_times, no cartesian product, partial limits before de-dup shuffles."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df):
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["extract_night", "extract_day", "combined_routes", "route_impact", "normalize_names"])
def test_no_python_no_cartesian(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "EvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_endpoints_are_one_aggregate(spark):
    p = E.queries()["trip_endpoints"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in p
    assert "partial_min" in p and "partial_max" in p  # combined before the shuffle


def test_dedup_uses_partial_group_limit(spark):
    p = E.queries()["extract_night"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert p.count("WindowGroupLimit") >= 4  # partial + final for DED1 and DED2


def test_scans_prune_columns(spark):
    p = E.queries()["trip_endpoints"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in p


def test_registry_is_the_broadcast_side(spark):
    """The feed registry (size-checked) is broadcast; trips are never the
    build side of that join."""
    import re

    p = plan(E.queries()["extract_night"](spark, SF))
    assert re.search(r"BroadcastHashJoin \[feed_id#\d+\], \[feed_id#\d+\], Inner, BuildRight", p)


def test_both_kinds_share_one_chain(spark):
    """Night and day routes come from one read, join and aggregate of the trips."""
    import re

    for name in ("combined_routes", "feed_ledger"):
        p = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"Aggregate \[(?:feed_id#\d+, )?trip_id#\d+", p)) == 1


def test_distance_is_computed_once_in_a_hashed_aggregate(spark):
    """The pairs' distance is not evaluated again by a filter, and DED1 sorts what a partial aggregate left."""
    p = E.queries()["extract_night"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in p.splitlines() if "ASIN(" in line]
    assert lines and all("HashAggregate" in line for line in lines)
    assert any("partial_min" in line for line in lines)


def test_flight_numbers_are_parsed_in_the_sample(spark):
    q = E.queries()["flight_sample"](spark, SF)._jdf.queryExecution()
    lines = q.optimizedPlan().toString().splitlines()
    parsed = [i for i, line in enumerate(lines) if "RLIKE(" in line]
    assert parsed and max(parsed) < next(i for i, line in enumerate(lines) if "Sort [" in line)
    assert "TakeOrderedAndProject" in q.executedPlan().toString()


def test_mode_sheet_is_dealt_to_all_cores(spark):
    from railtrace.plans import driver_views as V

    assert V.mode_sheet(spark, SF).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
