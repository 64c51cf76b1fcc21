"""Feeds and sheets that must not lose rows: odd paths, bad feeds, part files, CSV runs."""

import os

import pytest
from pyspark.sql import functions as F

from railtrace.operators import extract as X
from railtrace.operators.countries import station_countries
from railtrace.plans.pipeline import run_pipeline
from railtrace.sources import gtfs as G
from railtrace.sources import sheets
from tests.gtfs_fixture import write_feeds


def routes(spark, feeds):
    tables = G.read_feeds(spark, G.feed_registry(spark, feeds))
    return sorted(tuple(r) for k in ("night", "day") for r in X.extract_routes(tables, k).collect())


def test_odd_and_relative_paths_read_the_same(spark, tmp_path, monkeypatch):
    expected = routes(spark, write_feeds(str(tmp_path / "plain")))
    odd = write_feeds(str(tmp_path / "with space %41 é#x"))
    assert routes(spark, odd) == expected and len(expected) == 9
    inventory = G.feed_inventory(spark, G.feed_registry(spark, odd), str(tmp_path / "with space %41 é#x"))
    assert inventory.where("n_files = 0").count() == G.feed_inventory(
        spark, G.feed_registry(spark, write_feeds(str(tmp_path / "plain2"))), str(tmp_path / "plain2")).where("n_files = 0").count()
    here = os.path.relpath(str(tmp_path / "plain"), spark._jvm.java.lang.System.getProperty("user.dir"))
    relative = [(f[0], os.path.join(here, os.path.relpath(f[1], str(tmp_path / "plain"))), *f[2:]) for f in write_feeds(str(tmp_path / "plain"))]
    assert routes(spark, relative) == expected


def test_one_bad_feed_is_skipped_with_a_reason(spark, tmp_path):
    feeds = write_feeds(str(tmp_path / "feeds"))
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "stops.txt").write_text("stop_id,stop_name,stop_lat,stop_lon\n1,A,1,1\n")
    (bad / "trips.txt").write_text("route_id,service_id,trip_id\nr,s,t\n")
    (bad / "routes.txt").write_text("route_id,route_type\nr,2\n")
    (bad / "stop_times.txt").write_text("trip_id,stop_id,stop_sequence\nt,1,1\n")
    registry = G.feed_registry(spark, [*feeds, ("bad", str(bad), "night", None)])
    tables = G.read_feeds(spark, registry)
    reason = {r.feed_id: r.skip_reason for r in tables.feeds.collect()}
    assert "route_short_name" in reason["bad"] and [k for k, v in reason.items() if v] == ["bad"]
    got = sorted(tuple(r) for k in ("night", "day") for r in X.extract_routes(tables, k).collect())
    assert got == routes(spark, feeds)


def test_a_file_without_a_feed_is_an_error(spark, tmp_path):
    file = tmp_path / "stops.txt"
    file.write_text("stop_id,stop_name,stop_lat,stop_lon\n1,A,1,1\n")
    owners = spark.createDataFrame([("file:/elsewhere/stops.txt", "f")], "_file string, feed_id string")
    df = G._read_group(spark, "stops", [str(file)], ["stop_id", "stop_name", "stop_lat", "stop_lon"], owners)
    with pytest.raises(Exception, match="no feed owns the file"):
        df.collect()


def test_sheet_order_goes_by_file_name(spark, tmp_path):
    folder = tmp_path / "sheet"
    folder.mkdir()
    (folder / "part-00000.csv").write_text("Mode,g\nPlane,1\n")
    (folder / "part-00001.csv").write_text("Mode,g\n" + "".join(f"m{i},{i}\n" for i in range(5000)))
    (folder / "part-00002.csv").write_text("Mode,g\nlast,1\n")
    rows = sheets.read_sheet(spark, str(folder)).orderBy("ord").collect()
    assert [r.Mode for r in rows] == ["Plane", *(f"m{i}" for i in range(5000)), "last"]
    assert len({r.ord for r in rows}) == len(rows)


def test_preamble_and_quoted_header(spark, tmp_path):
    file = tmp_path / "f.csv"
    file.write_text('x\ny\nz\n1stCity,"a, b",PAX\nParis,1,2\n')
    df = sheets.read_sheet(spark, str(file), skip_rows=3)
    assert df.columns == ["ord", "1stCity", "a, b", "PAX"] and df.first()["a, b"] == "1"


def test_only_a_missing_reference_means_defaults(spark, tmp_path):
    with pytest.warns(UserWarning, match="default factors"):
        assert sheets.emission_reference_table(spark, str(tmp_path / "none")) is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        sheets.emission_reference_table(spark, str(tmp_path / "broken")).collect()
    with pytest.raises(Exception):
        sheets.emission_reference_table(spark, str(tmp_path), fmt="nosuchformat")


def test_csv_run_with_a_relative_folder(spark, tmp_path):
    tables = G.read_feeds(spark, G.feed_registry(spark, write_feeds(str(tmp_path / "feeds"))))
    (tmp_path / "modes.csv").write_text("Mode,gCO2,gCO2 RF,Note\nNight Train*,14,14,x\nPlane,144,389,x\n")
    modes = sheets.mode_sheet(spark, str(tmp_path / "modes.csv"))
    here = os.path.relpath(str(tmp_path / "out"), spark._jvm.java.lang.System.getProperty("user.dir"))
    csv_run = run_pipeline(spark, tables, here, modes, fmt="csv")
    parquet_run = run_pipeline(spark, tables, str(tmp_path / "p"), modes)
    assert csv_run.step_rows == parquet_run.step_rows and "routes_by_country_type" in csv_run.outputs
    for name, df in parquet_run.outputs.items():
        if name in ("environmental_impact", "impact_totals"):
            df, other = (d.drop("calculation_date") for d in (df, csv_run.outputs[name]))
        else:
            other = csv_run.outputs[name]
        assert sorted(map(str, df.collect())) == sorted(map(str, other.collect())), name
    for run in (csv_run, parquet_run):
        manifest = {r.dataset: r for r in run.manifest.collect()}
        assert all(r.exists for r in manifest.values())
        assert manifest["all_routes_cleaned"].rows == run.step_rows["all_routes_cleaned"]


def test_a_map_of_any_size_by_equi_join(spark):
    keys = spark.range(100_500).select(
        F.col("id").cast("int").alias("ord"), F.concat(F.lit("key "), "id").alias("key"), F.col("id").cast("string").alias("code"))
    stations = spark.createDataFrame([("at key 100499 x",), ("key 7",), ("none",), ("9999",), (None,)], "station string")
    day = station_countries(stations, keys, both_directions=False)
    assert {r.station: r.map_code for r in day.collect()} == {"at key 100499 x": "1", "key 7": "7", "none": None, "9999": None, None: None}
    night = station_countries(stations, keys, both_directions=True)
    assert {r.station: r.map_code for r in night.collect()}["9999"] == "9999"
    assert "NestedLoop" not in night._jdf.queryExecution().toString() and "Cartesian" not in night._jdf.queryExecution().toString()
