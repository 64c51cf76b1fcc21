"""Explicit schemas.  Ids are always strings: inference turns ``007`` into 7
and makes int/string unions fail under ANSI mode."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# GTFS columns actually used, by table, in the order we select them.
GTFS_COLUMNS = {
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon"],
    "trips": ["trip_id", "route_id", "start_stop_id", "end_stop_id"],
    "routes": ["route_id", "route_short_name"],
    "stop_times": ["trip_id", "stop_id", "stop_sequence"],
}
GTFS_OPTIONAL = {"trips": {"start_stop_id", "end_stop_id"}}
GTFS_REQUIRED_FILES = ["stops.txt", "trips.txt", "routes.txt"]
GTFS_ALL_FILES = ["stops.txt", "trips.txt", "stop_times.txt", "routes.txt"]

FEEDS = T.StructType([
    T.StructField("feed_id", S, False),
    T.StructField("path", S, True),
    T.StructField("kind", S, False),
    T.StructField("country", S, True),
    T.StructField("ord", T.IntegerType(), False),
])

DISTANCE = T.DecimalType(12, 2)
FACTOR = T.DecimalType(12, 6)
KG = T.DecimalType(18, 2)
PERCENT = T.DecimalType(9, 1)

ROUTE_COLUMNS = [
    "route_name", "origin", "destination", "service_type",
    "route_name_simple", "origin_country", "destination_country", "distance_km",
]
CLEAN_COLUMNS = ROUTE_COLUMNS + ["type"]

EXTRACTED_ROUTES = T.StructType(
    [T.StructField(c, S, True) for c in ROUTE_COLUMNS[:-1]]
    + [T.StructField("distance_km", DISTANCE, True)]
)
CLEANED_ROUTES = T.StructType(EXTRACTED_ROUTES.fields + [T.StructField("type", S, True)])

EMISSION_REFERENCE = T.StructType([
    T.StructField("ord", T.LongType(), True),
    T.StructField("transport_mode", S, True),
    T.StructField("gco2_per_pkm", T.DoubleType(), True),
    T.StructField("gco2_per_pkm_rf3", T.DoubleType(), True),
    T.StructField("source", S, True),
    T.StructField("year", T.IntegerType(), True),
])

FLIGHT_SHEET_COLUMNS = {
    "1stCity": "origin_city",
    "2ndCity": "destination_city",
    "PAX": "passengers_2019",
    "Distance": "distance_km",
    "TrainTime": "train_time_hours",
    "AviationEmissions": "aviation_emissions_tco2e",
    "NightTrain": "train_emissions_tco2e",
}
