from decimal import Decimal
from math import asin, cos, radians, sin, sqrt


from railtrace.functions.countries import day_country, night_country
from railtrace.functions.geo import haversine_km
from railtrace.operators.countries import resolve_countries, station_map_frame
from railtrace.functions.countries import DAY_STATION_COUNTRIES, NIGHT_STATION_COUNTRIES


def py_haversine(a, b, c, d):
    a, b, c, d = map(radians, (a, b, c, d))
    x = sin((c - a) / 2) ** 2 + cos(a) * cos(c) * sin((d - b) / 2) ** 2
    return round(2 * asin(sqrt(x)) * 6371, 2)


def test_distance_fixtures(spark):
    rows = [(48.8443, 2.3743, 45.7606, 4.8599), (52.0, 4.0, 48.0, 16.0), (0.0, 0.0, 0.0, 180.0),
            (47.0, 8.0, 47.0, 8.0), (None, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r.x for r in df.select(haversine_km("a", "b", "c", "d").alias("x")).collect()]
    assert got == [Decimal("390.72"), Decimal("964.53"), Decimal("20015.09"), Decimal("0.00"), None]


def test_distance_text_coordinates(spark):
    df = spark.createDataFrame([("48.8443", "2.3743", "45.7606", "4.8599"), ("abc", "1", "2", "3")], "a string, b string, c string, d string")
    got = [r.x for r in df.select(haversine_km("a", "b", "c", "d").alias("x")).collect()]
    assert got == [Decimal(str(py_haversine(48.8443, 2.3743, 45.7606, 4.8599))), None]


def test_country_fixtures(spark):
    df = spark.createDataFrame(
        [("nord", None), ("venice", None), ("zurich hb", None), ("nowhere", None), ("", None), ("anything", "CH"), ("paris nord", "")],
        "s string, fc string",
    )
    out = df.select(night_country("s", "fc").alias("n"), day_country("s", "fc").alias("d")).collect()
    assert [r.n for r in out] == ["FR", "FR", "CH", "UNKNOWN", "UNKNOWN", "CH", "FR"]
    assert [r.d for r in out] == [None, None, "CH", None, None, "CH", "FR"]


def test_country_join_equals_expression(spark):
    names = ["nord", "venice", "zurich hb", "nowhere", "", "paris gare du nord", "koln hbf", "london st pancras", "essen"]
    routes = spark.createDataFrame([(a, b, None) for a in names for b in names[:3]], "origin string, destination string, feed_country string")
    for kind, mapping, rule in (("night", NIGHT_STATION_COUNTRIES, night_country), ("day", DAY_STATION_COUNTRIES, day_country)):
        joined = resolve_countries(routes, station_map_frame(spark, mapping), kind)
        expr = routes.select("origin", "destination",
                             rule("origin", "feed_country", mapping).alias("origin_country"),
                             rule("destination", "feed_country", mapping).alias("destination_country"))
        a = sorted(tuple(r) for r in joined.select("origin", "destination", "origin_country", "destination_country").collect())
        b = sorted(tuple(r) for r in expr.collect())
        assert a == b
