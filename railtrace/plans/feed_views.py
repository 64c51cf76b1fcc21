"""The GTFS views of the test tables as feeds in files, written below the shared folder.

Each feed has its own folder, with a folder of part files per table.  Feeds of even and odd
place have other columns, in another order; odd ones quote names and bring endpoint
columns; three feeds lack stop_times, and of the two day feeds among them one has the
endpoint columns and one does not.  Into stop_times go lines that are no records: by the
part key, one with a field too many, one with fields missing, and one broken inside quotes.
``oracle.py`` counts all of them from the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtrace.plans import driver_views as V
from railtrace.session import ensure_checkpoint_dir
from railtrace.sources import gtfs as G

# Fixed test parameters: feeds without stop_times, part files of a table, and keys of bad lines.
LACKING = ["night/3-MEDIUM", "day/4-NOT SPECIFIED", "day/5-LOW"]
PARTS = {"stops": 1, "trips": 2, "routes": 1, "stop_times": 4}
EXTRA_FIELD, FEW_FIELDS, LINE_BREAK = 97, 89, 83

_TEXT = "coalesce(CAST({} AS STRING), '')"
# the columns of even and odd feeds; an expression stands for an extra column
LAYOUTS = {
    "stops": ([("stop_id",), ("stop_name",), ("stop_lat",), ("stop_lon",)],
              [("stop_lon",), ("platform_code", "'p'"), ("stop_name", "concat('\"', replace(stop_name, '\"', '\"\"'), '\"')"), ("stop_id",), ("stop_lat",)]),
    "trips": ([("route_id",), ("service_id", "'s'"), ("trip_id",)],
              [("trip_id",), ("start_stop_id",), ("end_stop_id",), ("route_id",)]),
    "routes": ([("route_id",), ("route_short_name",)],
               [("route_long_name", "'\"a, b\"'"), ("route_short_name",), ("route_id",), ("route_type", "'2'")]),
    "stop_times": ([("trip_id",), ("arrival_time", "'08:00'"), ("stop_id",), ("stop_sequence",)],
                   [("stop_sequence",), ("stop_id",), ("trip_id",)]),
}


def folder_of(feed_id: str) -> str:
    return "feed-" + feed_id.replace("/", "-").replace(" ", "-")


def write_feeds(spark: SparkSession, sf_dir: str, bad_lines: bool = True, lacking: bool = False) -> tuple[DataFrame, str]:
    """(registry, root) of the feeds in a new folder; one job writes them all."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/feeds-{uuid.uuid4().hex}"
    views = V.gtfs_scoped(spark, sf_dir)
    feeds = [(f"{kind}/{p}", kind, c, i) for kind, countries in (("night", V.NIGHT_FEED_COUNTRIES), ("day", V.DAY_FEED_COUNTRIES))
             for i, (p, c) in enumerate(zip(V.PRIORITIES, countries))]
    place = spark.createDataFrame([(f, folder_of(f), i % 2) for f, _, _, i in feeds], "feed_id string, folder string, odd int")
    heads = spark.createDataFrame(
        [(folder_of(f), f"{t}.txt", part, "﻿" * (t == "stops") + ",".join(c[0] for c in LAYOUTS[t][i % 2]))
         for f, _, _, i in feeds for t in LAYOUTS for part in range(PARTS[t])],
        "folder string, file string, part int, line string",
    ).withColumn("is_row", F.lit(False))
    lines = heads
    for t, layouts in LAYOUTS.items():
        texts = [f"concat_ws(',', {', '.join(c[1] if len(c) > 1 else _TEXT.format(c[0]) for c in layout)})" for layout in layouts]
        rows = getattr(views, t).join(F.broadcast(place), "feed_id").withColumn("line", F.expr(f"CASE odd WHEN 0 THEN {texts[0]} ELSE {texts[1]} END"))
        if t == "stop_times" and bad_lines:
            key = "CAST(stop_id AS BIGINT)"
            bad = ", ".join(f"CASE WHEN {key} % {k} = 0 THEN {line} END" for k, line in (
                (EXTRA_FIELD, "concat(line, ',x')"), (FEW_FIELDS, "trip_id"), (LINE_BREAK, "concat('\"', trip_id, '\n', line, '\"')")))
            rows = rows.withColumn("line", F.explode(F.expr(f"filter(array(line, {bad}), x -> x IS NOT NULL)")))
        rows = rows.select("folder", F.lit(f"{t}.txt").alias("file"), F.expr(f"CAST(pmod(hash(line), {PARTS[t]}) AS INT)").alias("part"), "line", F.lit(True).alias("is_row"))
        lines = lines.unionByName(rows)
    if lacking:
        gone = ", ".join(f"'{folder_of(f)}'" for f in LACKING)
        lines = lines.where(f"NOT (file = 'stop_times.txt' AND folder IN ({gone}))")
    keys = ["folder", "file", "part"]
    lines.repartition(*keys).sortWithinPartitions(*keys, "is_row").drop("is_row").write.partitionBy(*keys).text(root)
    return G.feed_registry(spark, [(f, f"{root}/folder={folder_of(f)}", kind, c) for f, kind, c, _ in feeds]).withColumn("ord", F.expr(f"ord % {len(V.PRIORITIES)}")), root
