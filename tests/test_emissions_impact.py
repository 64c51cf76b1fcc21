import datetime as dt
from decimal import Decimal

from railtrace.operators import emissions as E
from railtrace.operators import impact as I

SHEET = [
    (0, "Night Train*", "14", "14", "x"),
    (1, " Plane (SAF) ", "80", "200", "x"),
    (2, "Plane**", "144", "389", "x"),
    (3, "Cargo ship", "5", "n/a", "x"),
    (4, "Car", "132", "132", "x"),
    (5, "*", "1,5", "", "x"),
    (6, None, "10", "10", "x"),
    (7, "Coach", "n/a", "1e3", "x"),
    (8, "night train (old)", "", "1.0d", "x"),
    (9, "Bus", "1e3", "30", "x"),
]
SCHEMA = "ord long, mode string, f string, frf string, extra string"


def ref(spark, rows=SHEET):
    return E.emission_reference(spark.createDataFrame(rows, SCHEMA))


def test_reference(spark):
    got = {r.ord: (r.transport_mode, r.gco2_per_pkm, r.gco2_per_pkm_rf3) for r in ref(spark).collect()}
    assert 6 not in got and len(got) == 9
    assert got[2] == ("Plane", 144.0, 389.0)
    assert got[5] == ("", None, None)
    assert got[7] == ("Coach", None, 1000.0)
    assert got[8] == ("night train (old)", None, None)


def test_summary_first_match_baselines(spark):
    got = {r.transport_mode: (r.vs_plane_savings_percent, r.vs_car_savings_percent) for r in E.emission_summary(ref(spark)).collect()}
    # plane baseline: first mode containing 'Plane' (80); car: first containing 'Car' ('Cargo ship', 5)
    assert got["Night Train"] == (Decimal("82.5"), Decimal("-180.0"))
    assert got["Cargo ship"] == (Decimal("93.8"), Decimal("0.0"))
    assert got["Bus"] == (Decimal("-1150.0"), Decimal("-19900.0"))
    assert "Coach" not in got and len(got) == 6


def test_factors_and_headline(spark):
    f = E.emission_factors(ref(spark)).first()
    assert (f.train_gco2_pkm, f.plane_gco2_pkm, f.car_gco2_pkm) == (Decimal("14"), Decimal("144"), Decimal("5"))
    h = E.headline_saving(ref(spark)).collect()
    assert [(r.night_train_gco2_pkm, r.plane_gco2_pkm, r.savings_percent) for r in h] == [(14.0, 80.0, Decimal("82.5"))]


def test_factor_traps(spark):
    rows = [(0, "Night Train", "n/a", "", ""), (1, "Car", "132", "", "")]
    f = E.emission_factors(ref(spark, rows)).first()
    assert (f.train_gco2_pkm, f.plane_gco2_pkm, f.car_gco2_pkm) == (None, Decimal("144"), Decimal("132"))
    assert E.headline_saving(ref(spark, rows)).count() == 0
    assert {r.vs_plane_savings_percent for r in E.emission_summary(ref(spark, rows)).collect()} == {None}
    zero = [(0, "Plane", "0", "", ""), (1, "Car", "132", "", "")]
    assert {r.vs_plane_savings_percent for r in E.emission_summary(ref(spark, zero)).collect()} == {None}
    d = E.emission_factors(None, spark).first()
    assert (d.train_gco2_pkm, d.plane_gco2_pkm, d.car_gco2_pkm) == (Decimal("14"), Decimal("144"), Decimal("132"))


def test_flights(spark):
    cols = ["ord", "1stCity", "2ndCity", "PAX", "Distance", "TrainTime", "AviationEmissions", "NightTrain"]
    rows = [(0, "Paris", "Berlin", "100", "900", "9", "50", "5"), (1, None, "Rome", "1", "1", "1", "99", "1"),
            (2, "Wien", "Roma", "200", "800", "n/a", "40", "5"), (3, "Oslo", "Bergen", "5", "300", "7", "50", "5"),
            (4, "Nice", "Lyon", "7", "300", "4", "999", "1")]
    sheet = spark.createDataFrame(rows, ", ".join(f"`{c}` {'long' if c == 'ord' else 'string'}" for c in cols))
    sample = E.flight_routes(sheet, 3)
    assert [r.origin_city for r in sample.orderBy("ord").collect()] == ["Paris", "Wien", "Oslo"]
    top = E.top_flights(sample, 2).collect()
    # tied savings (45.0): sheet order decides
    assert [(r.origin_city, r.co2_savings_tco2e) for r in top] == [("Paris", 45.0), ("Oslo", 45.0)]


def test_impact(spark):
    routes = spark.createDataFrame(
        [("a", "b", "r1", Decimal("390.72"), "FR", "DE", "night"), ("c", "c", "r2", Decimal("0.00"), None, None, "day")],
        "origin string, destination string, route_name string, distance_km decimal(12,2), origin_country string, "
        "destination_country string, type string",
    )
    factors = E.emission_factors(None, spark)
    imp = I.environmental_impact(routes, factors, dt.date(2020, 1, 1))
    got = {r.origin: (r.train_co2_kg, r.plane_co2_kg, r.co2_savings_kg, r.savings_percent, r.calculation_date) for r in imp.collect()}
    assert got["a"] == (Decimal("5.47"), Decimal("56.26"), Decimal("50.79"), Decimal("90.3"), dt.date(2020, 1, 1))
    assert got["c"][:4] == (Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), None)
    t = I.impact_totals(imp).first()
    assert (t.total_routes, t.total_co2_savings_kg, t.total_co2_savings_tons, t.avg_savings_per_route_kg) == (
        2, Decimal("50.79"), Decimal("0.05"), Decimal("25.40"))
    assert [tuple(r) for r in I.impact_by_country(imp).collect()] == [("FR", 1, Decimal("50.79"), Decimal("0.05"))]
    assert [r.origin for r in I.top_routes(imp, 1).collect()] == ["a"]
    assert "distance_km" in imp.columns


def test_savings_identity_on_driver_tables(spark):
    """plane - train = savings within 0.01 kg on every route."""
    import __spark_entry__ as entry
    from pyspark.sql import functions as F

    imp = entry.queries()["route_impact"](spark, "/root/testdata/sf0.001")
    bad = imp.filter(F.abs(F.col("plane_co2_kg") - F.col("train_co2_kg") - F.col("co2_savings_kg")) > F.lit(0.01)).count()
    assert bad == 0 and imp.count() > 0
