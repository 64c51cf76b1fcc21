"""The registered query set over the star-schema test tables.

Every query reads whole tables through ``driver_views`` and runs the library
operators unchanged; ``plans.oracle`` states the same computation in DuckDB
SQL.  Keys here and in ``oracle.ORACLE_SQL`` are identical.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtrace.functions.countries import day_country, night_country
from railtrace.functions.geo import haversine_km
from railtrace.functions.text import is_blank, normalize_text, simplify_station, title_case_station
from railtrace.operators import clean as C
from railtrace.operators import emissions as E
from railtrace.operators import extract as X
from railtrace.operators import impact as I
from railtrace.plans import driver_views as V
from railtrace.plans import feed_views as FV
from railtrace.plans import sheet_views as SV
from railtrace.plans.pipeline import INPUTS, run_pipeline
from railtrace.schemas import GTFS_COLUMNS
from railtrace.session import ensure_checkpoint_dir
from railtrace.sinks.manifest import dataset_audit
from railtrace.sinks.publish import listing_fingerprint
from railtrace.sources import feed_files as FF
from railtrace.sources import sheets as S

# Fixed test parameters.
CALCULATION_DATE = dt.date(2019, 12, 31)
FLIGHT_SAMPLE = 50
AUDITED_TABLES = {
    "customer": ["c_custkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "nation": ["n_nationkey"],
    "orders": ["o_orderkey"],
    "part": ["p_partkey"],
    "region": ["r_regionkey"],
    "supplier": ["s_suppkey"],
}

Query = Callable[[SparkSession, str], DataFrame]


def _gtfs(spark, sf, fallback=False):
    return V.gtfs(spark, sf, fallback)


def trip_endpoints(spark, sf):
    return X.trip_endpoints(V.stop_times(spark, sf), scope=())


def trip_routes(spark, sf):
    t = _gtfs(spark, sf)
    return X.attach_stations(X.trip_stop_ids(t, "night"), t).select(
        "feed_id", "trip_id", "route_name", "origin_name", "destination_name"
    )


def endpoint_fallback(spark, sf):
    return X.trip_stop_ids(_gtfs(spark, sf, fallback=True), "day").select(
        "feed_id", "trip_id", "first_stop_id", "last_stop_id"
    )


def route_distance(spark, sf):
    t = _gtfs(spark, sf)
    pairs = X.trip_endpoints(t.stop_times, scope=()).select("first_stop_id", "last_stop_id").distinct()
    df = pairs.join(X.stop_role(t, "origin"), "first_stop_id").join(X.stop_role(t, "destination"), "last_stop_id")
    return df.select(
        "first_stop_id", "last_stop_id",
        haversine_km("origin_lat", "origin_lon", "dest_lat", "dest_lon").alias("distance_km"),
    ).filter(F.col("distance_km").isNotNull())


def _documents(spark, sf):
    return V.documents(spark, sf)


def normalize_names(spark, sf):
    return _documents(spark, sf).select("doc_id", normalize_text("text").alias("normalized"))


def simplify_names(spark, sf):
    return _documents(spark, sf).select("doc_id", simplify_station(normalize_text("text")).alias("simplified"))


def title_names(spark, sf):
    return _documents(spark, sf).select("doc_id", title_case_station(normalize_text("text")).alias("titled"))


def _stations(spark, sf):
    s = V.stops(spark, sf)
    return s.filter(~is_blank("stop_name")).select(normalize_text("stop_name").alias("station")).distinct()


def country_night(spark, sf):
    return _stations(spark, sf).select(
        "station", night_country("station", F.lit(None), V.DRIVER_STATION_MAP).alias("country")
    )


def country_day(spark, sf):
    return _stations(spark, sf).select(
        "station", day_country("station", F.lit(None), V.DRIVER_STATION_MAP).alias("country")
    )


def _stations_join(spark, sf, kind):
    from railtrace.operators.countries import resolve_countries, station_map_frame

    m = station_map_frame(spark, V.DRIVER_STATION_MAP)
    st = _stations(spark, sf)
    return resolve_countries(st, m, kind, columns=("station",)).select(
        "station", F.col("station_country").alias("country"))


def country_join_night(spark, sf):
    """JON7 as an equi-join with the map table (same result as ``country_night``)."""
    return _stations_join(spark, sf, "night")


def country_join_day(spark, sf):
    return _stations_join(spark, sf, "day")


def dedupe_pairs_feed(spark, sf):
    return X.feed_routes(_gtfs(spark, sf), "night", V.DRIVER_STATION_MAP)


# One GtfsTables per query; queries over both kinds extract them in one chain.

def _extract(t, kind):
    return X.extract_routes(t, kind, V.DRIVER_STATION_MAP)


def _clean_night(t):
    return C.clean_night(_extract(t, "night"))


def _clean_day(t):
    return C.clean_routes(_extract(t, "day"), "day")


def _combined(t):
    return C.clean_and_combine(_extract(t, None))


def extract_night(spark, sf):
    return _extract(_gtfs(spark, sf), "night")


def extract_day(spark, sf):
    return _extract(_gtfs(spark, sf), "day")


# ids that collide between feeds: every key holds the feed, as on files
def extract_night_scoped(spark, sf):
    return _extract(V.gtfs_scoped(spark, sf), "night")


def extract_day_scoped(spark, sf):
    return _extract(V.gtfs_scoped(spark, sf), "day")


def endpoint_fallback_scoped(spark, sf):
    return X.trip_stop_ids(V.gtfs_scoped(spark, sf, fallback=True), "day").select(
        "feed_id", "trip_id", "first_stop_id", "last_stop_id"
    )


# the same views as feeds in files: listed, judged and read by tasks

def _from_files(spark, sf, lacking=False):
    return FF.read_feed_files(spark, *FV.write_feeds(spark, sf, lacking=lacking))


def extract_night_files(spark, sf):
    return _extract(_from_files(spark, sf).tables, "night")


def extract_day_files(spark, sf):
    return _extract(_from_files(spark, sf).tables, "day")


def feed_quarantine(spark, sf):
    """Lines of each feed's tables: accepted, and rejected by reason."""
    files = _from_files(spark, sf)
    good = None
    for t in GTFS_COLUMNS:
        rows = getattr(files.tables, t).groupBy("feed_id").count().withColumn("tab", F.lit(t)).withColumn("reason", F.lit("accepted"))
        good = rows if good is None else good.unionByName(rows)
    bad = files.rejects.groupBy("feed_id", "tab", "reason").count()
    return good.unionByName(bad).select("feed_id", "tab", "reason", F.col("count").alias("records"))


def feed_inventory(spark, sf):
    """SRC6, SRC7, OPS15 over files: which feeds are usable, their records, and totals."""
    files = _from_files(spark, sf, lacking=True)
    counts = None
    for t in GTFS_COLUMNS:
        rows = getattr(files.tables, t).select("feed_id")
        counts = rows if counts is None else counts.unionByName(rows)
    counts = counts.unionByName(files.rejects.select("feed_id")).groupBy("feed_id").agg(F.count("*").alias("records"))
    per_feed = files.inventory.join(counts, "feed_id", "left").fillna(0, ["records"])
    return FF.inventory_totals(per_feed)


def feed_ledger(spark, sf):
    """AGG7 per feed: what every rule of the extraction leaves of a feed's route patterns."""
    return X.feed_ledger(V.gtfs_scoped(spark, sf))


# stop names that FLT1 drops, null or blank, by the stop's key
BLANK_NAME = "CASE WHEN stop_id % 11 = 0 THEN NULL WHEN stop_id % 13 = 0 THEN '  ' ELSE stop_name END"


def feed_ledger_blank(spark, sf):
    """FLT1, AGG7: the ledger where some stops have no name."""
    t = V.gtfs_scoped(spark, sf)
    n = t.feed_count
    t = replace(t, stops=t.stops.withColumn("stop_name", F.expr(BLANK_NAME))).known_feed_count(n)
    return X.feed_ledger(t)


def unresolved_day(spark, sf):
    return X.unresolved_countries(extract_day(spark, sf))


def clean_night(spark, sf):
    return _clean_night(_gtfs(spark, sf))


def clean_day(spark, sf):
    return _clean_day(_gtfs(spark, sf))


def combined_routes(spark, sf):
    return _combined(_gtfs(spark, sf))


# rows as they come before cleaning: null and blank names, labels without text
RAW = [
    "route_name", "CASE WHEN origin LIKE 'red%' THEN NULL ELSE origin END AS origin",
    "CASE WHEN destination LIKE 'hot%' THEN '  ' ELSE destination END AS destination",
    "CASE WHEN distance_km < 100 THEN NULL ELSE service_type END AS service_type",
    "CASE WHEN origin LIKE 'old%' THEN NULL WHEN origin LIKE 'new%' THEN ' ' ELSE route_name_simple END AS route_name_simple",
    "origin_country", "destination_country", "distance_km",
]


def quality_raw(spark, sf):
    """AGG4, AGG5 over rows that have something to count."""
    return C.quality_report(extract_day(spark, sf).selectExpr(*RAW))


def clean_raw(spark, sf):
    """PRJ8: labels that are null or blank are made from the cleaned names."""
    return C.clean_routes(extract_day(spark, sf).selectExpr(*RAW), "raw")


def preview_day(spark, sf):
    """TOP4."""
    return C.preview(extract_day(spark, sf), 10)


def quality_report(spark, sf):
    return C.quality_report(clean_day(spark, sf))


def routes_by_country(spark, sf):
    return X.routes_by_origin_country(combined_routes(spark, sf))


def routes_by_type(spark, sf):
    return C.routes_by_type(combined_routes(spark, sf))


def routes_by_country_type(spark, sf):
    return C.routes_by_country_type(combined_routes(spark, sf))


def _reference(spark, sf):
    return E.emission_reference(V.mode_sheet(spark, sf))


def emission_reference(spark, sf):
    return _reference(spark, sf)


def emission_summary(spark, sf):
    return E.emission_summary(_reference(spark, sf))


def _flights(spark, sf):
    return E.flight_routes(V.flight_sheet(spark, sf), FLIGHT_SAMPLE)


def flight_sample(spark, sf):
    return _flights(spark, sf).drop("ord")


def flight_top5(spark, sf):
    return E.top_flights(_flights(spark, sf), 5)


def emission_factors(spark, sf):
    return E.emission_factors(_reference(spark, sf))


# sheets without one of the modes, or without a number
LACKING_MODES = ["night train", "plane", "car"]


def factor_defaults(spark, sf):
    """LKP1: a missing mode takes its default; a mode whose factor is no number stays null."""
    sheet = V.mode_sheet(spark, sf)
    cases = {m: sheet.where(f"NOT contains(lower(c0), '{m}')") for m in LACKING_MODES}
    cases["numbers"] = sheet.withColumn("c1", F.lit("n/a"))
    out = None
    for name, rows in cases.items():
        one = E.emission_factors(E.emission_reference(rows)).withColumn("without", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def first_factors_files(spark, sf):
    """SRC11: the first factor of each mode, of a sheet whose order is that of its files."""
    reference = E.emission_reference(S.mode_sheet(spark, SV.write_mode_sheet(spark, sf)))
    return reference.groupBy("transport_mode").agg(
        E.first_match("gco2_per_pkm", "true").v.alias("gco2_per_pkm"), F.count("*").alias("n"))


def flight_sample_files(spark, sf):
    """SRC12, TOP3: the first flights of a sheet of several files."""
    return E.flight_routes(S.flight_sheet(spark, SV.write_flight_sheet(spark, sf)), FLIGHT_SAMPLE).drop("ord")


def headline_saving(spark, sf):
    return E.headline_saving(_reference(spark, sf))


def route_impact(spark, sf):
    return I.environmental_impact(combined_routes(spark, sf), emission_factors(spark, sf), CALCULATION_DATE)


def impact_totals(spark, sf):
    return I.impact_totals(route_impact(spark, sf))


def impact_by_country(spark, sf):
    return I.impact_by_country(route_impact(spark, sf))


def impact_by_country_top10(spark, sf):
    return I.top_countries(impact_by_country(spark, sf), 10)


def impact_by_type(spark, sf):
    return I.impact_by_type(route_impact(spark, sf))


def impact_top10(spark, sf):
    return I.top_routes(route_impact(spark, sf), 10)


def output_manifest(spark, sf):
    tables = {name: (V.read_table(spark, sf, name), keys) for name, keys in AUDITED_TABLES.items()}
    return dataset_audit(tables).select("dataset", "rows", "duplicate_keys")


def published_outputs(spark, sf):
    """SNK1-SNK4, OPS16, OPS17: the manifest of all that a run writes, reads back and publishes.
    The tables are files, so the run knows them by their listing and reads them once."""
    tables = ("part", "lineitem", "orders", "customer", "nation")
    files = listing_fingerprint(spark, [f"{sf.rstrip('/')}/{t}.parquet" for t in tables], "*.parquet")
    run = run_pipeline(
        spark, _gtfs(spark, sf), f"{ensure_checkpoint_dir(spark).rstrip('/')}/outputs-{uuid.uuid4().hex}",
        V.mode_sheet(spark, sf), V.flight_sheet(spark, sf), V.DRIVER_STATION_MAP, V.DRIVER_STATION_MAP,
        calculation_date=CALCULATION_DATE, flight_sample=FLIGHT_SAMPLE, known=dict.fromkeys(INPUTS, files),
    )
    return run.manifest.select("dataset", "exists", (F.col("bytes") > 0).alias("has_bytes"), "rows", "duplicate_keys")


QUERIES: dict[str, Query] = {
    name: globals()[name]
    for name in [
        "trip_endpoints", "trip_routes", "endpoint_fallback", "route_distance",
        "normalize_names", "simplify_names", "title_names",
        "country_night", "country_day", "country_join_night", "country_join_day", "dedupe_pairs_feed",
        "extract_night", "extract_day", "unresolved_day",
        "extract_night_scoped", "extract_day_scoped", "endpoint_fallback_scoped",
        "extract_night_files", "extract_day_files", "feed_quarantine", "feed_inventory", "feed_ledger", "feed_ledger_blank",
        "clean_night", "clean_day", "combined_routes", "quality_report",
        "quality_raw", "clean_raw", "preview_day",
        "routes_by_country", "routes_by_type", "routes_by_country_type",
        "emission_reference", "emission_summary", "flight_sample", "flight_top5",
        "emission_factors", "factor_defaults", "first_factors_files", "flight_sample_files", "headline_saving",
        "route_impact", "impact_totals", "impact_by_country", "impact_by_country_top10", "impact_by_type", "impact_top10",
        "output_manifest", "published_outputs",
    ]
}
