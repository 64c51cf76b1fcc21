"""Station -> country for a map held in a DataFrame (JON7).

``functions.countries`` compiles an in-memory map into a CASE expression;
this operator does the same lookup when the map is a table
``(ord, key, code)`` of any size.  Containment becomes an equi-join: each
*distinct* station is expanded into its substrings of the lengths that keys
have, and (for the other direction) each key into its substrings.  Names and
keys are short, so the expansions are linear in the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtrace.functions.countries import UNKNOWN, has_feed_country

_SUBSTRINGS = (
    "array_distinct(flatten(transform({lengths}, n -> "
    "CASE WHEN n = 0 THEN array('') WHEN n > length({c}) THEN CAST(array() AS array<string>) "
    "ELSE transform(sequence(1, length({c}) - n + 1), i -> substring({c}, i, n)) END)))"
)


def station_countries(stations: DataFrame, station_map: DataFrame, both_directions: bool) -> DataFrame:
    """Distinct ``station`` values -> first matching ``code`` in ``ord`` order
    (null when no key matches)."""
    m = station_map.select("ord", F.lower(F.trim("key")).alias("key"), "code").where("key IS NOT NULL")
    s = stations.select("station").distinct()
    lengths = m.agg(F.array_sort(F.collect_set(F.length("key"))).alias("n")).scalar()
    parts = s.withColumn("lengths", lengths).select(
        "station", F.explode(F.expr(_SUBSTRINGS.format(lengths="coalesce(lengths, array())", c="station"))).alias("key")
    )
    found = parts.join(m, "key").select("station", "ord", "code")
    if both_directions:
        inside = m.select("ord", "code", F.explode(F.expr(
            _SUBSTRINGS.format(lengths="sequence(0, length(key))", c="key"))).alias("station"))
        found = found.unionByName(s.join(inside, "station").select("station", "ord", "code"))
    codes = found.groupBy("station").agg(F.min_by("code", "ord").alias("map_code"))
    codes = codes.withColumnRenamed("station", "_found")
    return s.join(codes, F.col("station") == F.col("_found"), "left").select("station", "map_code")


def resolve_countries(
    routes: DataFrame, station_map: DataFrame, kind: str, feed_country: str = "feed_country",
    columns=("origin", "destination"),
) -> DataFrame:
    """Adds ``<column>_country`` for each station column: the feed country
    when set, else the map lookup (night: both directions, empty station and
    no match -> UNKNOWN; day: one direction, no match -> null)."""
    night = kind == "night"
    stations = None
    for c in columns:
        part = routes.select(F.col(c).alias("station"))
        stations = part if stations is None else stations.unionByName(part)
    lookup = station_countries(stations, station_map, both_directions=night)
    out = routes
    for c in columns:
        looked = lookup.select(F.col("station").alias(c), F.col("map_code").alias(f"_{c}_code"))
        out = out.join(looked, c, "left")
        code = F.col(f"_{c}_code")
        if night:
            code = F.when(F.col(c).isNull() | (F.col(c) == ""), F.lit(UNKNOWN)).otherwise(F.coalesce(code, F.lit(UNKNOWN)))
        fc = F.col(feed_country) if feed_country in routes.columns else F.lit(None).cast("string")
        out = out.withColumn(f"{c}_country", F.when(has_feed_country(fc), fc).otherwise(code)).drop(f"_{c}_code")
    return out


def station_map_frame(spark, mapping) -> DataFrame:
    """An ordered (key, code) list as a map table."""
    return spark.createDataFrame([(i, k, c) for i, (k, c) in enumerate(mapping)], "ord int, key string, code string")
