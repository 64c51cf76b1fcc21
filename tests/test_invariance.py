"""Results do not depend on partitioning or on the order of rows."""

from dataclasses import replace

import pytest

from railtrace.operators import clean as C
from railtrace.operators import extract as X
from railtrace.sources.gtfs import feed_registry, read_feeds
from tests.gtfs_fixture import write_feeds

COLS = ["route_name", "origin", "destination", "service_type", "route_name_simple", "origin_country",
        "destination_country", "distance_km"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("feeds"))
    return read_feeds(spark, feed_registry(spark, write_feeds(root)))


def result(t):
    night = C.clean_night(X.extract_routes(t, "night"))
    day = C.clean_routes(X.extract_routes(t, "day"), "day")
    return sorted(tuple(r) for r in C.combine_types(night, day).select(*COLS, "type").collect())


def test_repartitioned_and_shuffled_inputs(spark, tables):
    base = result(tables)
    from pyspark.sql import functions as F

    mixed = replace(
        tables,
        stops=tables.stops.repartition(7).orderBy(F.rand(1)),
        trips=tables.trips.repartition(3),
        stop_times=tables.stop_times.repartition(5).orderBy(F.rand(2)),
        routes=tables.routes.repartition(2),
    )
    assert result(mixed) == base and len(base) > 0


def test_registry_order(spark, tables):
    base = result(tables)
    from pyspark.sql import functions as F

    reversed_feeds = tables.feeds.withColumn("ord", F.lit(100) - F.col("ord"))
    assert result(tables.with_feeds(reversed_feeds)) == base


def test_both_kinds_in_one_chain_are_the_two_tables(spark, tables):
    base = result(tables)
    both = X.extract_routes(tables, None)
    for kind in ("night", "day"):
        alone = X.extract_routes(tables, kind)
        assert sorted(map(tuple, both.where(f"service_type = '{kind}'").select(*COLS).collect())) == sorted(map(tuple, alone.select(*COLS).collect()))
    assert sorted(tuple(r) for r in C.clean_and_combine(both).select(*COLS, "type").collect()) == base
    assert {r[-1] for r in base} == {"night", "day"}


def test_one_ledger_of_both_kinds(spark, tables):
    rows = sorted(tuple(r) for r in X.feed_ledger(tables).collect())
    alone = [tuple(r) for kind in ("night", "day") for r in X.feed_ledger(tables, kind).collect()]
    assert rows == sorted(alone) and len(rows) > 4
