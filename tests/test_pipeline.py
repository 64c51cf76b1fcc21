import datetime as dt

from railtrace.plans.pipeline import run_pipeline
from railtrace.sources.gtfs import feed_registry, read_feeds
from railtrace.sources.routes import read_cleaned_routes
from railtrace.sources.sheets import emission_reference_table, flight_sheet, mode_sheet
from tests.gtfs_fixture import write_feeds


def test_pipeline_end_to_end(spark, tmp_path):
    root = tmp_path / "feeds"
    tables = read_feeds(spark, feed_registry(spark, write_feeds(str(root))))
    (tmp_path / "modes.csv").write_text("Mode,gCO2,gCO2 RF,Note\nNight Train*,14,14,x\nPlane,144,389,x\nCar,132,132,x\n")
    (tmp_path / "flights.csv").write_text(
        "Flights 2019\n(preamble)\n\n1stCity,2ndCity,PAX,Distance,TrainTime,AviationEmissions,NightTrain\n"
        "Paris,Berlin,100,900,9,50,5\nWien,,1,1,1,1,1\nOslo,Bergen,5,300,7,40,5\n")
    modes = mode_sheet(spark, str(tmp_path / "modes.csv"))
    flights = flight_sheet(spark, str(tmp_path / "flights.csv"))
    out = tmp_path / "out"
    res = run_pipeline(spark, tables, str(out), modes, flights, calculation_date=dt.date(2024, 1, 1))

    assert res.step_rows["night_routes"] == 7 and res.step_rows["day_routes"] == 2
    assert res.step_rows["flight_routes_sample"] == 2
    # UNKNOWN destination (Koln -> Nowhere) is excluded from cleaned night routes
    assert res.step_rows["night_routes_cleaned"] == 6
    assert res.step_rows["all_routes_cleaned"] == res.step_rows["environmental_impact"] == 8
    man = {r.dataset: r for r in res.manifest.collect()}
    assert all(r.exists and r.bytes > 0 for r in man.values())
    assert man["all_routes_cleaned"].duplicate_keys == 0 and man["environmental_impact"].rows == 8
    # outputs read back with explicit schemas
    cleaned = read_cleaned_routes(spark, str(out / "all_routes_cleaned"))
    assert cleaned.count() == 8 and dict(cleaned.dtypes)["distance_km"] == "decimal(12,2)"
    ref = emission_reference_table(spark, str(out / "emissions_reference"))
    assert ref.count() == 3
    assert emission_reference_table(spark, str(out / "missing")) is None
