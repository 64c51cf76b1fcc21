from decimal import Decimal
from math import asin, cos, radians, sin, sqrt

import pytest

from railtrace.operators import extract as X
from railtrace.sources.gtfs import feed_inventory, feed_registry, read_feeds
from tests.gtfs_fixture import write_feeds


def km(a, b, c, d):
    a, b, c, d = map(radians, (a, b, c, d))
    x = sin((c - a) / 2) ** 2 + cos(a) * cos(c) * sin((d - b) / 2) ** 2
    return Decimal(str(round(2 * asin(sqrt(x)) * 6371, 2))).quantize(Decimal("0.01"))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("feeds"))
    reg = feed_registry(spark, write_feeds(root))
    return read_feeds(spark, reg), reg, root


def rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_ids_stay_text(tables):
    t, _, _ = tables
    ids = {r.stop_id for r in t.stops.filter("feed_id = 'A'").collect()}
    assert {"007", "7", "8503000:0:1"} <= ids


def test_endpoints_rule(tables):
    t, _, _ = tables
    ends = {(r.feed_id, r.trip_id): (r.first_stop_id, r.last_stop_id) for r in X.trip_endpoints(t.stop_times).collect()}
    assert ends[("A", "T1")] == ("007", "8503000:0:1")
    assert ends[("A", "T3")] == ("S6", "S6")  # one-stop trip
    assert ends[("A", "T6")] == ("007", "S6")  # text sequence -> null -> first; tie on 1 -> larger id last
    assert ends[("F", "T1")] == ("007", "7")   # same ids, other feed


def test_night_extraction(tables):
    t, _, _ = tables
    got = rows(X.extract_routes(t, "night"), ["route_name", "origin", "destination", "service_type",
                                               "route_name_simple", "origin_country", "destination_country", "distance_km"])
    expected = sorted([
        # A: T1/T2 are one undirected pair; the smaller origin wins (geneve)
        ("EN 123", "geneve", "zurich hb", "night", "Geneve → Zurich Hb", "CH", "CH", km(46.2104, 6.1424, 47.3779, 8.5403)),
        ("Brig → Brig", "brig", "brig", "night", "Brig → Brig", "CH", "CH", Decimal("0.00")),
        ("Zürich HB → Brig", "zurich hb", "brig", "night", "Zurich Hb → Brig", "CH", "CH", km(47.3779, 8.5403, 46.3196, 7.9882)),
        # B: map lookup, reordered columns
        # B1 (NJ 40, Paris->Munchen) and B4 (blank name, Munchen->Paris) are one pair; smaller origin wins
        ("München Hbf → Paris Nord", "munchen hbf", "paris nord", "night", "Munchen → Paris Nord", "DE", "FR",
         km(48.1402, 11.5586, 48.8809, 2.3553)),
        ("NJ 40", "nord", "venice santa lucia", "night", "Nord → Venice Santa Lucia", "FR", "FR",
         km(48.88, 2.36, 45.4410, 12.3211)),
        ("Köln Hbf → Nowhere", "koln hbf", "nowhere", "night", "Koln → Nowhere", "DE", "UNKNOWN", km(50.9430, 6.9583, 1.0, 1.0)),
        # F: ids of A, own stations; country from the night map
        ("EN 123", "wien hbf", "salzburg hbf", "night", "Wien → Salzburg", "AT", "AT", km(48.1852, 16.3760, 47.8128, 13.0459)),
    ])
    assert got == expected


def test_day_fallback_and_skips(tables):
    t, _, _ = tables
    got = rows(X.extract_routes(t, "day"), ["route_name", "origin", "destination", "origin_country", "destination_country"])
    assert got == sorted([
        ("Eurostar", "london st pancras international", "bruxelles midi", "GB", "BE"),
        ("Eurostar", "lille europe", "unknownville", "FR", None),
    ])
    unresolved = X.unresolved_countries(X.extract_routes(t, "day")).collect()
    assert [(r.origin, r.destination_country) for r in unresolved] == [("lille europe", None)]


def test_feed_inventory(spark, tables):
    _, reg, root = tables
    inv = {r.feed_id: r for r in feed_inventory(spark, reg, root, count_rows=True).collect()}
    assert inv["A"].usable and inv["A"].n_files == 4 and inv["A"].data_rows == 6 + 8 + 3 + 15
    assert not inv["E"].usable and inv["E"].missing == ["routes.txt"]
    assert not inv["C-night"].usable and inv["C-night"].missing == ["stop_times.txt"]
    assert inv["C"].usable and not inv["C"].has_stop_times
    assert inv["D"].has_required and inv["D"].usable


def test_routes_by_country(tables):
    t, _, _ = tables
    got = [tuple(r) for r in X.routes_by_origin_country(X.extract_routes(t, "night")).collect()]
    assert got == [("CH", 3), ("DE", 2), ("AT", 1), ("FR", 1)]


def test_rows_alike_but_for_distance(spark):
    """Stops of one name at several places, one without coordinates: the least distance stays; a pair
    whose every row lacks a distance goes."""
    from railtrace.sources.gtfs import GtfsTables

    stops = [("1", "Graz", 47.07, 15.41), ("2", "Graz", 47.5, 15.0), ("3", "Graz", None, 15.0), ("4", "Wien", 48.18, 16.37),
             ("5", "Brig", None, 7.98)]
    ends = [("1", "4"), ("2", "4"), ("3", "4"), ("4", "2"), ("4", "5"), ("1", "4")]
    tables = GtfsTables(
        stops=spark.createDataFrame(stops, "stop_id string, stop_name string, stop_lat double, stop_lon double"),
        trips=spark.createDataFrame([("f", f"T{i}", "R") for i in range(len(ends))], "feed_id string, trip_id string, route_id string"),
        routes=spark.createDataFrame([("R", "EN")], "route_id string, route_short_name string"),
        stop_times=spark.createDataFrame(
            [(f"T{i}", s, n) for i, pair in enumerate(ends) for n, s in enumerate(pair)], "trip_id string, stop_id string, stop_sequence int"),
        feeds=spark.createDataFrame([("f", "night", None, 0)], "feed_id string, kind string, country string, ord int"), scope=(),
    )
    for kind in ("night", None):
        got = X.feed_routes(tables, kind).collect()
        assert [(r.origin, r.destination, r.route_name, r.distance_km) for r in got] == [
            ("graz", "wien", "EN", min(km(47.07, 15.41, 48.18, 16.37), km(47.5, 15.0, 48.18, 16.37)))]
