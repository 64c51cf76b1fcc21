"""Route extraction (OPS1-OPS3): GTFS feeds -> one row per rail route.

Plan, in the order Spark runs it (SURVEY 3.2 and 4):

1. ``trip_endpoints``: one aggregate over ``stop_times`` (the largest table)
   gives each trip's first and last stop.  It is partial-aggregated before the
   shuffle, and replaces the reference's two window sorts plus join.
2. trips of the requested kind (broadcast registry, a handful of rows) are
   joined to the endpoints on the trip key; the aggregate's output is already
   hash-partitioned on that key, so only ``trips`` is shuffled.
3. early reduction: ``distinct(feed, route, first stop, last stop)`` -- every
   later step depends only on these, so repeated departures collapse here.
4. routes and the two stop roles are joined as dimensions.  String work
   (normalization) happens on the stops dimension, not per trip.  Spark picks
   broadcast or sort-merge from the size of global tables; tables of feeds are
   joined by shuffle (``_shuffled``).
5. expressions (route name, Haversine), the least distance of rows that are
   alike but for it, then DED1 with a total order, then country resolution and
   display names on the surviving rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtrace.functions.countries import country_rule, default_station_map
from railtrace.functions.geo import haversine_km
from railtrace.functions.text import ROUTE_ARROW, is_blank, route_label, simplify_station
from railtrace.operators.dedup import dedupe_directed, dedupe_pairs
from railtrace.schemas import ROUTE_COLUMNS
from railtrace.sources.gtfs import MAX_BROADCAST_ROWS, GtfsTables


def trip_endpoints(stop_times: DataFrame, scope=("feed_id",)) -> DataFrame:
    """WIN1/WIN2: first and last stop of every trip.

    Order is ``(stop_sequence, stop_id)``; a null sequence sorts first, so it
    is the first stop and never the last one while a non-null exists -- the
    reference's ``row_number`` rule, made total by ``stop_id``.  Sequences are
    parsed with ``try_cast`` (bad text -> null, PRJ2).
    """
    keys = [*scope, "trip_id"]
    point = F.struct(
        F.col("stop_sequence").try_cast("int").alias("seq"),
        F.col("stop_id").cast("string").alias("stop_id"),
    )
    return stop_times.groupBy(*keys).agg(
        F.min(point).stop_id.alias("first_stop_id"),
        F.max(point).stop_id.alias("last_stop_id"),
    )


def _shuffled(table: DataFrame, scope) -> DataFrame:
    """A table to be joined by shuffle if its ids are those of feeds.

    Such tables come from tasks that read files, or from copies of a shared table per feed.  The
    planner guesses their size from what they are made of, far too low, and a table that it
    takes for small would go through the driver whole."""
    return table.hint("merge") if scope else table


def _feeds_of_kind(tables: GtfsTables, kind: str | None) -> DataFrame:
    feeds = tables.feeds
    cols = set(feeds.columns)
    has_st = "coalesce(has_stop_times, true)" if "has_stop_times" in cols else "true"
    has_req = "coalesce(has_required, false)" if "has_required" in cols else "true"
    # night feeds need all four files
    of_kind = {"night": f"kind = 'night' AND {has_st}", "day": "kind = 'day'"}
    wanted = " OR ".join(f"({of_kind[k]})" for k in ([kind] if kind else of_kind))
    out = feeds.filter(f"({wanted}) AND {has_req}").selectExpr(
        "feed_id", "country AS feed_country", "ord AS feed_ord", f"{has_st} AS has_stop_times", *([] if kind else ["kind"]),
    )
    # one row per feed folder; broadcast after its row count is checked (a
    # registry built from Python rows has no size statistics for the planner)
    return F.broadcast(out) if tables.feed_count <= MAX_BROADCAST_ROWS else out


def trip_stop_ids(tables: GtfsTables, kind: str | None) -> DataFrame:
    """Trips of ``kind`` with their origin and destination stop ids; of both kinds, with a
    column ``kind``, where it is None.

    Feeds with ``stop_times`` use the endpoint aggregate; day feeds without it
    fall back to ``trips.start_stop_id / end_stop_id`` (JON6; SURVEY D1: here
    the fallback yields routes because coordinates are carried).
    """
    scope = list(tables.scope)
    keys = [*scope, "trip_id"]
    trips = tables.trips
    for c in ("start_stop_id", "end_stop_id"):
        if c not in trips.columns:
            trips = trips.withColumn(c, F.lit(None).cast("string"))
    trips = trips.select(*dict.fromkeys(["feed_id", *keys, "route_id", "start_stop_id", "end_stop_id"]))
    feeds = _feeds_of_kind(tables, kind)
    t = trips.join(feeds, "feed_id")
    stop_times = tables.stop_times
    if "feed_id" in scope:
        # only this kind's feeds are aggregated (with feed-partitioned storage
        # the filter prunes whole folders)
        stop_times = stop_times.join(feeds.select("feed_id"), "feed_id", "left_semi")
    # JON4/JON5: one join brings both endpoints (they come from one aggregate)
    t = t.join(_shuffled(trip_endpoints(stop_times, scope), scope), keys, "left")
    if kind == "night":
        first, last = F.col("first_stop_id"), F.col("last_stop_id")
    else:  # night feeds have stop_times
        first = F.when(F.col("has_stop_times"), F.col("first_stop_id")).otherwise(F.col("start_stop_id"))
        last = F.when(F.col("has_stop_times"), F.col("last_stop_id")).otherwise(F.col("end_stop_id"))
    return t.select(
        *dict.fromkeys(["feed_id", *keys]), *([] if kind else ["kind"]), "feed_country", "feed_ord", "route_id",
        first.alias("first_stop_id"), last.alias("last_stop_id"),
    ).filter("first_stop_id IS NOT NULL AND last_stop_id IS NOT NULL")


def stop_role(tables: GtfsTables, role: str) -> DataFrame:
    """PRJ1: stops dimension in one endpoint role (``origin_*`` / ``dest_*``),
    with its normalized name; joined by JON2 (origin) and JON3 (destination).

    FLT1 (name non-null and non-blank) is applied on the dimension."""
    scope = list(tables.scope)
    pre = "origin" if role == "origin" else "dest"
    name = "origin_name" if role == "origin" else "destination_name"
    norm = "origin" if role == "origin" else "destination"
    key = "first_stop_id" if role == "origin" else "last_stop_id"
    return _shuffled(tables.stop_names.selectExpr(
        *scope,
        f"stop_id AS {key}", f"stop_name AS {name}", f"stop_lat AS {pre}_lat",
        f"stop_lon AS {pre}_lon", f"norm_name AS {norm}",
    ), scope)


def route_name(short_name, origin_name, destination_name) -> Column:
    """PRJ6: the short name unless null, blank, or equal (trimmed) to the
    origin name; then ``origin → destination`` from the raw names."""
    if isinstance(short_name, str):
        sn, o, d = f"`{short_name}`", f"`{origin_name}`", f"`{destination_name}`"
        return F.expr(
            f"CASE WHEN {sn} IS NULL OR trim({sn}) = '' OR trim({sn}) = trim({o}) "
            f"THEN concat({o}, '{ROUTE_ARROW}', {d}) ELSE {sn} END"
        )
    o, d = F.col(origin_name), F.col(destination_name)
    return F.when(is_blank(short_name) | (F.trim(short_name) == F.trim(o)), route_label(o, d)).otherwise(short_name)


def attach_stations(endpoints: DataFrame, tables: GtfsTables) -> DataFrame:
    """JON1-JON5 + FLT1 + PRJ6: route short name and both stations."""
    scope = list(tables.scope)
    routes = _shuffled(tables.routes.select(*scope, "route_id", "route_short_name"), scope)
    df = endpoints.join(routes, [*scope, "route_id"], "left")  # JON1
    # JON2 / JON3; inner joins: FLT1 would drop the unmatched rows anyway
    df = df.join(stop_role(tables, "origin"), [*scope, "first_stop_id"])
    df = df.join(stop_role(tables, "destination"), [*scope, "last_stop_id"])
    return df.withColumn("route_name", route_name("route_short_name", "origin_name", "destination_name"))


KINDS = ("night", "day")

# Total order for DED1: decides which row represents an undirected pair.
FEED_PAIR_ORDER = ["origin", "destination", "route_name", "distance_km", "origin_name", "destination_name"]


def feed_routes(tables: GtfsTables, kind: str | None, station_map=None) -> DataFrame:
    """OPS1/OPS2 per feed: one row per undirected station pair within a feed.

    Columns: feed_id, feed_ord and the eight route columns.  ``kind`` None gives the routes of
    both kinds from one chain of joins; ``station_map`` is then one map for both, or a dict of
    kind and map.  A map that is None is the kind's default.
    """
    maps = station_map if isinstance(station_map, dict) else dict.fromkeys(KINDS, station_map)
    patterns = trip_stop_ids(tables, kind).drop("trip_id").distinct()
    df = attach_stations(patterns, tables)
    # SCL3, FLT2 (distance 0 is kept).  Of rows that differ by distance alone the least comes first in
    # FEED_PAIR_ORDER, so DED1 needs no other.  This aggregate is hashed and partial before the shuffle,
    # where DED1 sorts; FLT2 follows it, as a filter on the distance would compute it a second time.
    alike = ["feed_id", "feed_ord", "feed_country", *([] if kind else ["kind"]), *[c for c in FEED_PAIR_ORDER if c != "distance_km"]]
    df = df.groupBy(*alike).agg(
        F.min(haversine_km("origin_lat", "origin_lon", "dest_lat", "dest_lon")).alias("distance_km")
    ).filter(F.col("distance_km").isNotNull())
    df = dedupe_pairs(df, "origin", "destination", ["feed_id"] if kind else ["feed_id", "kind"], FEED_PAIR_ORDER)

    def country(station: str) -> Column:
        by_kind = {
            k: country_rule(k)(station, "feed_country", default_station_map(k) if maps[k] is None else maps[k])
            for k in ([kind] if kind else KINDS)
        }
        return by_kind[kind] if kind else F.when(F.col("kind") == "night", by_kind["night"]).otherwise(by_kind["day"])

    # PRJ10 final projection; PRJ3 service_type; PRJ7 display name (SCL2);
    # SCL4/SCL5 countries
    return df.select(
        "feed_id", "feed_ord",
        "route_name", "origin", "destination",
        (F.lit(kind) if kind else F.col("kind")).alias("service_type"),
        route_label(simplify_station("origin"), simplify_station("destination")).alias("route_name_simple"),
        country("origin").alias("origin_country"),
        country("destination").alias("destination_country"),
        "distance_km",
    )


def with_drop_rule(tables: GtfsTables, kind: str | None) -> DataFrame:
    """Route patterns with ``rule``, the first filter that drops them (FLT1: a station without
    a usable name; FLT2: no distance; null: neither).  ``feed_routes`` keeps the rows without one."""
    scope = list(tables.scope)
    patterns = trip_stop_ids(tables, kind).drop("trip_id").distinct()
    routes = _shuffled(tables.routes.select(*scope, "route_id", "route_short_name"), scope)
    df = patterns.join(routes, [*scope, "route_id"], "left")
    df = df.join(stop_role(tables, "origin"), [*scope, "first_stop_id"], "left")
    df = df.join(stop_role(tables, "destination"), [*scope, "last_stop_id"], "left")
    df = df.withColumn("route_name", route_name("route_short_name", "origin_name", "destination_name"))
    df = df.withColumn("distance_km", haversine_km("origin_lat", "origin_lon", "dest_lat", "dest_lon"))
    return df.withColumn("rule", F.expr(
        "CASE WHEN origin IS NULL OR destination IS NULL THEN 'FLT1' WHEN distance_km IS NULL THEN 'FLT2' END"
    ))


def feed_ledger(tables: GtfsTables, kind: str | None = None, station_map=None) -> DataFrame:
    """AGG7 per feed: patterns, what FLT1, FLT2, DED1 and DED2 drop of them, and what is kept.

    One aggregate over (feed, rule, undirected pair) counts the filters' and DED1's drops and gives each
    pair's representative; counts are partial before the shuffle, so a hot pair is one row per task.
    DED2 keeps a directed route of the first feed that has it, and a feed has it once, so the least
    (ord, feed) over a route says which row is kept; that window sees a row per feed and route, and two
    per feed of what the filters drop.  Countries come after these in DED2's order, so ``station_map``
    changes no count.  The numbers of a feed add up: patterns = dropped + kept.
    """
    order = ", ".join(FEED_PAIR_ORDER)
    pair = "CASE WHEN rule IS NULL THEN {}(origin, destination) END"
    rows = with_drop_rule(tables, kind)
    if kind:
        rows = rows.withColumn("kind", F.lit(kind))
    groups = rows.groupBy(
        "feed_id", "feed_ord", "kind", "rule", F.expr(pair.format("least")).alias("lo"), F.expr(pair.format("greatest")).alias("hi")
    ).agg(F.count("*").alias("n"), F.min(F.expr(f"struct({order})")).alias("first"))
    feed = "struct(feed_ord, feed_id)"
    route = "PARTITION BY kind, rule, first.origin, first.destination, first.route_name"
    first_feed = groups.withColumn("kept", F.expr(f"rule IS NULL AND {feed} = min({feed}) OVER ({route})"))
    sums = first_feed.groupBy("feed_id", "kind").agg(
        F.sum("n").alias("patterns"), F.sum(F.expr("CASE WHEN rule = 'FLT1' THEN n END")).alias("flt1"),
        F.sum(F.expr("CASE WHEN rule = 'FLT2' THEN n END")).alias("flt2"),
        F.sum(F.expr("CASE WHEN rule IS NULL THEN n - 1 END")).alias("ded1"), F.count_if("kept").alias("kept"),
    )
    feeds = tables.feeds.where(F.col("kind").isin(*([kind] if kind else KINDS))).select("feed_id", "kind")
    return feeds.join(sums, ["feed_id", "kind"], "left").select(
        "feed_id", "kind", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("patterns", "flt1", "flt2", "ded1", "kept")],
    ).withColumn("ded2", F.expr("patterns - flt1 - flt2 - ded1 - kept"))


# Total order for DED2: first feed in registry order wins.
ACROSS_FEEDS_ORDER = ["feed_ord", "feed_id", "distance_km", "route_name_simple", "origin_country", "destination_country"]


def combine_feeds(per_feed: DataFrame, within=()) -> DataFrame:
    """OPS3 (SET1 + DED2): one row per directed (origin, destination, route_name)."""
    return dedupe_directed(per_feed, [*within, "origin", "destination", "route_name"], ACROSS_FEEDS_ORDER).select(*ROUTE_COLUMNS)


def extract_routes(tables: GtfsTables, kind: str | None = "night", station_map=None) -> DataFrame:
    """OPS1 (night) / OPS2 (day) followed by OPS3: the extracted route table.

    ``kind`` None gives both tables as one, told apart by ``service_type``: the rows are those
    of the two, but every table is read, joined and shuffled once."""
    return combine_feeds(feed_routes(tables, kind, station_map), () if kind else ("service_type",))


def unresolved_countries(routes: DataFrame) -> DataFrame:
    """AGG8: routes where either country is null (day rule leaves them null)."""
    return routes.filter(F.col("origin_country").isNull() | F.col("destination_country").isNull()).select(
        "origin", "destination", "origin_country", "destination_country"
    )


def routes_by_origin_country(routes: DataFrame) -> DataFrame:
    """AGG1: route count per origin country, largest first (ties by key)."""
    return routes.groupBy("origin_country").agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.col("count").desc(), F.col("origin_country").asc_nulls_first()
    )
