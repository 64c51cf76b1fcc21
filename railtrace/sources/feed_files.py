"""Feeds read from their files by tasks alone (SRC1-SRC7).

A feed is a folder that holds a file, or a folder of part files, for each of its tables
(``stops.txt``, ``trips.txt``, ``routes.txt``, ``stop_times.txt``); every file begins with its own
header.  One listing finds the files of all feeds; tasks read the first lines, and from
then on the files are rows of a table: the gate that says which feeds are usable, and
the splits that tasks read, are DataFrame expressions over it.  The driver sees the feed
registry and the numbers of splits, no file and no header, so a thousand feeds need
the same jobs as one.

A split is a range of bytes of a file; a line belongs to the split that its first byte is in.
Columns are taken by name and stay text; an empty field is null, a quoted empty one is not.
Nothing is padded or cut in silence: a line with too few or too many fields, or with a
quote that does not end on it (a line break inside a quoted field makes two of
those), is a row of ``rejects`` with its file and the offset of its first byte.  Accepted rows plus rejects
are the lines of the files without headers and empty lines.  A file without a byte counts as absent.

Paths are read with pyarrow's file systems (``file:``, ``hdfs:``, ``s3:``, ``gs:``); feeds in a store that
only Spark can read go through ``gtfs.read_feeds``.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtrace.schemas import GTFS_ALL_FILES, GTFS_COLUMNS, GTFS_OPTIONAL, GTFS_REQUIRED_FILES
from railtrace.session import ensure_checkpoint_dir
from railtrace.sources.gtfs import MAX_BROADCAST_ROWS, GtfsTables, _file_uri, qualified

SPLIT_BYTES = 64 << 20
CHUNK = 1 << 20  # bytes that a task parses at once, unless a line is longer; its rows hold many times as much
HEADER_BYTES = 1 << 20  # a first line is sought in so many
TOO_FEW, TOO_MANY, OPEN_QUOTE = "too few fields", "too many fields", "open quote"

_REJECT = "reason string, file string, offset long, record string"


@dataclass(frozen=True)
class FeedFiles:
    """Accepted rows as ``tables``; ``rejects``: feed_id, table, file, offset, reason, record;
    ``headers``: a row per file of a feed; ``inventory``: a row per feed."""

    tables: GtfsTables
    rejects: DataFrame
    headers: DataFrame
    inventory: DataFrame


def _open(uri: str):
    from pyarrow import fs

    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(unquote(parts.path))
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def feed_files(spark: SparkSession, registry: DataFrame, root: str) -> DataFrame:
    """``feed_id, kind, ord, tab, path, length``: a row per file of a feed, from one listing of ``root``.

    Feeds may share a folder; a feed without files has no row."""
    names = "|".join(GTFS_COLUMNS)
    place = rf"^(.*)/(?:[^/=]+=)?({names})\.txt(?:/.*)?$"
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(root)
        .select(_file_uri().alias("path"), "length")
        .select("path", "length", F.regexp_extract("path", place, 1).alias("folder"), F.regexp_extract("path", place, 2).alias("tab"))
        .where("tab <> ''")
    )
    feeds = registry.select("feed_id", "kind", "ord", "path").collect()  # one row per feed folder
    owners = spark.createDataFrame(
        [(f["feed_id"], f["kind"], f["ord"], qualified(spark, f["path"])) for f in feeds],
        "feed_id string, kind string, ord int, folder string",
    )
    owners = F.broadcast(owners) if len(feeds) <= MAX_BROADCAST_ROWS else owners
    return listed.join(owners, "folder").select("feed_id", "kind", "ord", "tab", "path", "length")


def feed_headers(files: DataFrame) -> DataFrame:
    """The files plus ``columns`` and ``begins``, the offset of the line after the header; first lines alone are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, begins = [], []
            for path in batch.column(4).to_pylist():
                with _open(path) as file:
                    head = file.read(HEADER_BYTES)
                line = head.split(b"\n", 1)[0]
                begins.append(len(line) + 1)
                text = line.decode("utf-8-sig", "replace").rstrip("\r")
                columns.append([c.strip() for c in next(csv.reader([text]), [])])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(columns, pa.list_(pa.string())), pa.array(begins, pa.int64())],
                names=[*batch.schema.names, "columns", "begins"],
            )

    schema = "feed_id string, kind string, ord int, tab string, path string, length long, columns array<string>, begins long"
    return files.mapInArrow(run, schema)


def inventory(registry: DataFrame, headers: DataFrame) -> DataFrame:
    """SRC6, SRC7: a row per feed: files, bytes, tables present and missing, usable and why not.

    A night feed needs all four tables; a day feed stops, trips and routes, and either stop_times or both
    endpoint columns in every file of its trips.  A feed whose file lacks a needed column is not usable.
    """
    needed = "map(" + ", ".join(
        f"'{t}', array({', '.join(repr(c) for c in cols if c not in GTFS_OPTIONAL.get(t, ()))})" for t, cols in GTFS_COLUMNS.items()
    ) + ")"
    lacks = headers.withColumn("lacks", F.expr(f"array_except({needed}[tab], columns)"))
    per_feed = lacks.groupBy("feed_id").agg(
        F.count("path").alias("n_files"), F.sum("length").alias("bytes"),
        F.collect_set(F.concat("tab", F.lit(".txt"))).alias("names"),  # at most four
        F.min(F.expr("CASE WHEN size(lacks) > 0 THEN concat(tab, '.txt has no column ', array_join(lacks, ', ')) END")).alias("skip_reason"),
        F.coalesce(F.expr("bool_and(array_contains(columns, 'start_stop_id') AND array_contains(columns, 'end_stop_id')) FILTER (WHERE tab = 'trips')"), F.lit(False)).alias("has_endpoints"),
    )
    names = F.expr("coalesce(names, CAST(array() AS array<string>))")
    required, every = (F.array(*[F.lit(n) for n in f]) for f in (GTFS_REQUIRED_FILES, GTFS_ALL_FILES))
    out = registry.select("feed_id", "kind", "country", "ord").join(per_feed, "feed_id", "left").select(
        "feed_id", "kind", "country", "ord", F.coalesce("n_files", F.lit(0)).alias("n_files"), F.coalesce("bytes", F.lit(0)).alias("bytes"),
        F.size(names).alias("n_tables"),
        F.array_join(F.array_except(F.when(F.col("kind") == "night", every).otherwise(required), names), ", ").alias("missing"),
        (F.size(F.array_except(required, names)) == 0).alias("has_required"),
        F.array_contains(names, "stop_times.txt").alias("has_stop_times"),
        F.coalesce("has_endpoints", F.lit(False)).alias("has_endpoints"), "skip_reason",
    )
    reason = (
        F.when(F.col("n_files") == 0, "no GTFS files")
        .when(F.col("missing") != "", F.concat(F.lit("missing files: "), "missing"))
        .when(F.col("skip_reason").isNotNull(), F.col("skip_reason"))
        .when((F.col("kind") == "day") & ~F.col("has_stop_times") & ~F.col("has_endpoints"), "neither stop_times nor endpoint columns")
    )
    return out.withColumn("reason", reason).withColumn("usable", F.col("reason").isNull())


def inventory_totals(per_feed: DataFrame) -> DataFrame:
    """SRC7, OPS15: one pass of grouping sets: each feed, each kind, and all feeds.

    ``per_feed`` has feed_id, kind, usable, reason, missing and numbers ``n_tables`` and ``records``."""
    return per_feed.groupingSets(
        [[F.col("kind"), F.col("feed_id")], [F.col("kind")], []], F.col("kind"), F.col("feed_id")
    ).agg(
        F.expr("CASE grouping_id() WHEN 0 THEN 'feed' WHEN 1 THEN 'kind' ELSE 'all' END").alias("level"),
        F.count(F.lit(1)).alias("feeds"), F.count_if("usable").alias("valid"), F.count_if(~F.col("usable")).alias("invalid"),
        F.sum("n_tables").cast("long").alias("tables"), F.count_if(F.col("missing") != "").alias("with_missing"),
        F.sum("records").cast("long").alias("records"),
        F.expr("CASE WHEN grouping_id() = 0 THEN max(reason) END").alias("reason"),
    )


def _splits(headers: DataFrame, table: str, split_bytes: int) -> DataFrame:
    files = headers.where(F.col("tab") == table)
    return files.selectExpr(
        "feed_id", "path", "columns", "begins",
        f"explode(sequence(0L, greatest(length - 1, 0L), {split_bytes}L)) AS first", "length",
    ).selectExpr(
        "feed_id", "path", "columns", "greatest(first, begins) AS first", f"least(first + {split_bytes}, length) AS past", "begins"
    ).where("first < past")


def _lines(path: str, first: int, past: int, begins: int) -> Iterator[tuple[int, list[bytes]]]:
    """(offset, lines) of the lines whose first byte is in [first, past), a ``CHUNK`` at a time."""
    with _open(path) as file:
        at = first
        if first > begins:  # the line that runs into the split belongs to the one before
            file.seek(first - 1)
            at, cut = first - 1, -1
            while cut < 0:
                more = file.read(1 << 16)
                if not more:
                    return
                cut = more.find(b"\n")
                at += cut + 1 if cut >= 0 else len(more)
            if at >= past:
                return
        file.seek(at)
        held = b""
        while at + len(held) < past:
            held += file.read(min(CHUNK, past - at - len(held)))
            cut = held.rfind(b"\n") + 1
            if at + len(held) >= past:
                while not held.endswith(b"\n"):  # the last line may end beyond the split
                    more = file.read(1 << 16)
                    if not more:
                        break
                    end = more.find(b"\n")
                    held += more if end < 0 else more[:end + 1]
                cut = len(held)
            if cut:
                yield at, held[:cut].split(b"\n")
                at, held = at + cut, held[cut:]


def _judged(path: str, offset: int, lines: list[bytes], n: int) -> tuple[list[bytes], list[tuple]]:
    """Lines of ``n`` fields, and the others with what is wrong."""
    good, bad = [], []
    for line in lines:
        size = len(line) + 1
        line = line.rstrip(b"\r")
        if line:
            fields = line.count(b",") + 1
            reason = None
            if b'"' in line:
                if line.count(b'"') % 2:
                    reason = OPEN_QUOTE
                else:
                    fields = len(next(csv.reader([line.decode("utf-8", "replace")])))
            if reason is None and fields != n:
                reason = TOO_FEW if fields < n else TOO_MANY
            if reason is None:
                good.append(line)
            else:
                bad.append((reason, path, offset, line.decode("utf-8", "replace")))
        offset += size
    return good, bad


def _table(headers: DataFrame, table: str, tasks: int, split_bytes: int) -> DataFrame:
    """All lines of a table: accepted ones with a null ``reason``, the others with null columns."""
    wanted = GTFS_COLUMNS[table]

    def rows(feed: str, columns: list[str], good: list[bytes], bad: list[tuple]) -> pa.RecordBatch:
        data = b"\n".join(good)
        try:
            data.decode()
        except UnicodeDecodeError:
            data = data.decode("utf-8", "replace").encode()
        found = {c: f"c{columns.index(c)}" for c in wanted if c in columns}
        n = len(good)
        parsed = None if not n else pacsv.read_csv(
            pa.BufferReader(data),
            read_options=pacsv.ReadOptions(column_names=[f"c{i}" for i in range(len(columns))], use_threads=False, block_size=max(1 << 20, 2 * len(data))),
            parse_options=pacsv.ParseOptions(newlines_in_values=False, ignore_empty_lines=True),
            convert_options=pacsv.ConvertOptions(
                include_columns=list(found.values()), column_types={c: pa.string() for c in found.values()},
                strings_can_be_null=True, null_values=[""], quoted_strings_can_be_null=False,
            ),
        )
        out = [pa.array([feed] * (n + len(bad)), pa.string())]
        for c in wanted:
            own = parsed.column(found[c]).chunks if n and c in found else [pa.nulls(n, pa.string())]
            out.append(pa.concat_arrays([*own, pa.nulls(len(bad), pa.string())]))
        for i, kind in enumerate((pa.string(), pa.string(), pa.int64(), pa.string())):
            out.append(pa.concat_arrays([pa.nulls(n, kind), pa.array([b[i] for b in bad], kind)]))
        return pa.RecordBatch.from_arrays(out, names=["feed_id", *wanted, "reason", "file", "offset", "record"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for feed, path, columns, first, past, begins in zip(*(c.to_pylist() for c in batch.columns)):
                for offset, lines in _lines(path, first, past, begins):
                    good, bad = _judged(path, offset, lines, len(columns))
                    if good or bad:
                        yield rows(feed, columns, good, bad)

    schema = "feed_id string, " + ", ".join(f"{c} string" for c in wanted) + ", " + _REJECT
    splits = _splits(headers, table, split_bytes)
    return splits.repartition(tasks).mapInArrow(run, schema)


def read_feed_files(spark: SparkSession, registry: DataFrame, root: str, split_bytes: int = SPLIT_BYTES) -> FeedFiles:
    """SRC5: all feeds of the registry, whose folders lie below ``root``.

    Feeds that the gate calls unusable for a missing column are left out whole, as ``inventory`` says.
    """
    ensure_checkpoint_dir(spark)
    headers = feed_headers(feed_files(spark, registry, root)).checkpoint()  # one row per file
    per_feed = inventory(registry, headers).checkpoint()  # one row per feed
    skipped = per_feed.where("skip_reason IS NOT NULL").select("feed_id")
    read = headers.join(skipped, "feed_id", "left_anti")
    sizes = {r.tab: r for r in read.groupBy("tab").agg(
        F.sum("length").alias("bytes"), F.sum(F.expr(f"1 + length DIV {split_bytes}")).alias("splits")
    ).collect()}  # at most four rows
    tables, rejects = {}, None
    for table, columns in GTFS_COLUMNS.items():
        r = sizes.get(table)
        cores = spark.sparkContext.defaultParallelism
        tasks = 1 if r is None else max(min(r.splits, cores), -(-r.bytes // split_bytes))
        lines = _table(read, table, tasks, split_bytes)
        tables[table] = lines.where("reason IS NULL").select("feed_id", *columns)
        bad = lines.where("reason IS NOT NULL").select("feed_id", F.lit(table).alias("tab"), "file", "offset", "reason", "record")
        rejects = bad if rejects is None else rejects.unionByName(bad)
    feeds = per_feed.select("feed_id", "kind", "country", "ord", "has_stop_times", "has_required", "skip_reason")
    return FeedFiles(GtfsTables(**tables, feeds=feeds), rejects, headers, per_feed)
