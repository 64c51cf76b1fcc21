"""GTFS feed sources (SRC1-SRC7).

A feed is a folder of GTFS ``.txt`` files.  Feeds are described by a registry
DataFrame ``(feed_id, path, kind, country, ord)``; ``kind`` is ``night`` or
``day`` (decided by the folder, as in the reference), ``country`` is the
feed's country code or null, ``ord`` the registry position (tie-break).

Reading rules (SURVEY 1.3):
* every file is read with its own header and *no* inference, so all columns
  are strings and ``007`` stays distinct from ``7``;
* columns are selected **by name** -- feeds may order columns differently or
  add columns -- and optional columns missing from a feed become typed nulls;
* every row is tagged with ``feed_id`` and all later join keys include it,
  because GTFS ids are unique only within a feed.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railtrace.schemas import FEEDS, GTFS_ALL_FILES, GTFS_COLUMNS, GTFS_OPTIONAL, GTFS_REQUIRED_FILES


@dataclass(frozen=True)
class GtfsTables:
    """The four GTFS tables of many feeds plus their registry.

    ``scope`` lists the columns that namespace stop/trip/route ids.  For feeds
    read from files it is ``("feed_id",)``.  Tables whose ids are global (one
    shared network, e.g. the star-schema test views) use ``()``; trips always
    carry ``feed_id`` because it links them to the registry.

    ``feeds`` columns: feed_id, kind, country, ord and optionally
    has_stop_times / has_required (file presence; both default to true).
    """

    stops: DataFrame
    trips: DataFrame
    routes: DataFrame
    stop_times: DataFrame
    feeds: DataFrame
    scope: tuple[str, ...] = field(default=("feed_id",))

    def with_feeds(self, feeds: DataFrame) -> "GtfsTables":
        return replace(self, feeds=feeds)

    @cached_property
    def feed_count(self) -> int:
        """Rows of the registry, the proof that it may be broadcast: counted
        once (a small job) unless the builder already knows it."""
        return self.feeds.count()

    def known_feed_count(self, n: int) -> "GtfsTables":
        """Record a registry size known from construction."""
        self.__dict__["feed_count"] = n
        return self

    @cached_property
    def stop_names(self) -> DataFrame:
        """Stops with a usable name (FLT1) and their normalized name, built
        once and shared by both endpoint roles and both kinds."""
        from railtrace.functions.text import is_blank, normalize_text

        return self.stops.filter(~is_blank("stop_name")).select(
            *self.scope,
            F.col("stop_id").cast("string").alias("stop_id"),
            "stop_name", "stop_lat", "stop_lon",
            normalize_text("stop_name").alias("norm_name"),
        )


def feed_registry(spark: SparkSession, feeds: Iterable[Sequence]) -> DataFrame:
    """Registry from ``(feed_id, path, kind, country)`` tuples; ``ord`` is the
    position in the given order (registry order is a tie-break, SURVEY D2)."""
    rows = [(f[0], f[1], f[2], f[3] if len(f) > 3 else None, i) for i, f in enumerate(feeds)]
    return spark.createDataFrame(rows, FEEDS)


# Largest configuration table (feeds, feed files) that is broadcast; larger
# ones are joined by shuffle.
MAX_BROADCAST_ROWS = 100_000
HEADER_THREADS = 16  # feed headers that the driver reads at a time


def _clean_name(name: str) -> str:
    return name.replace("\ufeff", "").strip()


def _header(spark: SparkSession, file: str) -> list[str] | None:
    """Column names of one CSV file (reads only its first line), or None if
    the file does not exist."""
    try:
        cols = spark.read.option("header", True).option("inferSchema", False).csv(file).columns
    except Exception as exc:  # missing file: the inventory explains the skip
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return None
        raise
    return [_clean_name(c) for c in cols]


def _read_group(spark: SparkSession, table: str, files: list[str], header: list[str], path_to_feed: DataFrame) -> DataFrame:
    """SRC1 (stops), SRC2 (trips), SRC3 (routes), SRC4 (stop_times) for all
    files of one table that share a header: one scan, columns selected by
    name, ``feed_id`` from the file path."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(files)
    raw = raw.toDF(*header)
    cols = []
    for name in GTFS_COLUMNS[table]:
        if name in header:
            cols.append(F.col(f"`{name}`").cast("string").alias(name))
        elif name in GTFS_OPTIONAL.get(table, ()):
            cols.append(F.lit(None).cast("string").alias(name))
        else:
            raise ValueError(f"{table}.txt in {files[0]} has no column {name!r}")
    tagged = raw.select(_file_uri().alias("_file"), *cols)
    # one row per feed file, counted on the driver: broadcast below the limit
    small = len(files) <= MAX_BROADCAST_ROWS
    joined = tagged.join(F.broadcast(path_to_feed) if small else path_to_feed, "_file", "left")
    # a file that no feed owns would lose its rows: fail instead
    owner = F.coalesce("feed_id", F.raise_error(F.concat(F.lit("no feed owns the file "), "_file")).cast("string"))
    return joined.select(owner.alias("feed_id"), *GTFS_COLUMNS[table])


def _empty(spark: SparkSession, table: str) -> DataFrame:
    schema = T.StructType([T.StructField("feed_id", T.StringType())]
                          + [T.StructField(c, T.StringType()) for c in GTFS_COLUMNS[table]])
    return spark.createDataFrame([], schema)


def read_feeds(spark: SparkSession, registry: DataFrame) -> GtfsTables:
    """SRC5: read every feed of the registry into four unioned tables.

    The registry is configuration-sized (one row per feed folder), so it is
    looked at on the driver.  Files of a table are grouped by their header:
    each group is one multi-file scan whose rows get ``feed_id`` from their
    file path, so a thousand feeds with a handful of column layouts make a
    handful of scans, not thousands.  The data is only ever read by tasks;
    headers are read by several driver threads at a time.

    A feed whose file lacks a needed column is left out whole, with the reason
    in ``feeds.skip_reason``; the others go on.
    """
    feeds = registry.select("feed_id", "path").orderBy("ord").collect()
    files = {(t, f["feed_id"]): f["path"].rstrip("/") + f"/{t}.txt" for t in GTFS_COLUMNS for f in feeds}
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        headers = dict(zip(files, pool.map(lambda file: _header(spark, file), files.values())))
    skipped: dict[str, str] = {}
    for (table, feed_id), header in headers.items():
        needed = [c for c in GTFS_COLUMNS[table] if c not in GTFS_OPTIONAL.get(table, ())]
        lacks = [c for c in needed if header is not None and c not in header]
        if lacks:
            skipped.setdefault(feed_id, f"{table}.txt has no column {', '.join(lacks)}")
    tables = {}
    present = {f["feed_id"]: set() for f in feeds}
    for table in GTFS_COLUMNS:
        groups: dict[tuple, list[tuple[str, str]]] = {}
        for f in feeds:
            header = headers[table, f["feed_id"]]
            if header is not None and f["feed_id"] not in skipped:
                present[f["feed_id"]].add(table)
                groups.setdefault(tuple(header), []).append((files[table, f["feed_id"]], f["feed_id"]))
        out = _empty(spark, table)
        for header, members in groups.items():
            path_to_feed = spark.createDataFrame(
                [(qualified(spark, file), fid) for file, fid in members], "_file string, feed_id string"
            )
            out = out.unionByName(_read_group(spark, table, [m[0] for m in members], list(header), path_to_feed))
        tables[table] = out
    flags = [
        (fid, "stop_times" in got, {"stops", "trips", "routes"} <= got, skipped.get(fid)) for fid, got in present.items()
    ]
    flag_df = spark.createDataFrame(
        flags, "feed_id string, has_stop_times boolean, has_required boolean, skip_reason string"
    )
    return GtfsTables(
        stops=tables["stops"],
        trips=tables["trips"],
        routes=tables["routes"],
        stop_times=tables["stop_times"],
        feeds=registry.join(flag_df, "feed_id", "left"),
    ).known_feed_count(len(feeds))


def qualified(spark: SparkSession, path: str) -> str:
    """A path's full URI, as its file system gives it and Spark reports it: absolute, with
    the default scheme and authority, percent-encoded, without a trailing slash."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return re.sub(r"^file:/+", "file:/", fs.makeQualified(hadoop).toUri().toString())


def _file_uri():
    """The URI of the file that a row comes from, written like ``qualified``."""
    return F.regexp_replace("_metadata.file_path", r"^file:/+", "file:/")


def feed_inventory(spark: SparkSession, registry: DataFrame, scan_root: str, count_rows: bool = False) -> DataFrame:
    """SRC6/SRC7 (OPS15): which GTFS files each feed has, and whether it is usable.

    Lists ``scan_root`` once with the ``binaryFile`` source (only path and
    length are selected, so file contents are never read).  Output columns:
    feed_id, kind, n_files, has_required, has_stop_times, missing, usable,
    reason, bytes; with ``count_rows`` also ``data_rows`` (lines minus header
    over all of the feed's .txt files, one distributed scan).
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.txt")
        .load(scan_root)
        .select(_file_uri().alias("path"), "length")
        .withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]+$", 1))
        .withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))
    )
    # one row per feed folder: qualified on the driver by the rule that the files' paths follow
    reg = spark.createDataFrame(
        [(r["feed_id"], r["kind"], r["ord"], qualified(spark, r["path"])) for r in registry.collect()],
        "feed_id string, kind string, ord long, folder string",
    )
    required = F.array(*[F.lit(n) for n in GTFS_REQUIRED_FILES])
    every = F.array(*[F.lit(n) for n in GTFS_ALL_FILES])
    per_feed = reg.join(files, "folder", "left").groupBy("feed_id", "kind", "ord").agg(
        F.count("name").alias("n_files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.collect_set("name").alias("_names"),
    )
    has_required = F.size(F.array_except(required, F.col("_names"))) == 0
    has_stop_times = F.array_contains(F.col("_names"), "stop_times.txt")
    missing = F.array_except(F.when(F.col("kind") == "night", every).otherwise(required), F.col("_names"))
    out = per_feed.select(
        "feed_id", "kind", "ord", "n_files",
        has_required.alias("has_required"),
        has_stop_times.alias("has_stop_times"),
        missing.alias("missing"),
        (F.size(missing) == 0).alias("usable"),
        F.when(F.col("n_files") == 0, F.lit("no GTFS files"))
        .when(F.size(missing) > 0, F.concat(F.lit("missing files: "), F.array_join(missing, ", ")))
        .alias("reason"),
        "bytes",
    )
    if count_rows:
        lines = (
            spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(scan_root)
            .select(_file_uri().alias("path"))
            .groupBy("path").agg((F.count(F.lit(1)) - 1).alias("rows"))
            .withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]+$", 1))
            .groupBy("folder").agg(F.sum("rows").alias("data_rows"))
        )
        out = out.join(reg.select("feed_id", "folder").join(lines, "folder", "left").drop("folder"), "feed_id", "left")
    return out.orderBy("ord").drop("ord")
