"""Feeds read from files by tasks: splits, quarantine, gate and inventory."""

import csv
import re
import tracemalloc

import pytest
from pyspark.sql import functions as F

from railtrace.operators import extract as X
from railtrace.plans import driver_views as V
from railtrace.schemas import GTFS_COLUMNS
from railtrace.sources import feed_files as FF
from railtrace.sources import gtfs as G
from tests.gtfs_fixture import FEEDS, REGISTRY, write_feeds

SF = "/root/testdata/sf0.001"


def plain_rows(table):
    """The fixture's rows of a table, parsed line by line."""
    out = []
    for feed, folder, _, _ in REGISTRY:
        lines = FEEDS[folder].get(f"{table}.txt", "").split("\n")
        header = next(csv.reader(lines[:1]), [])
        for line in filter(None, lines[1:]):
            row = dict(zip(header, next(csv.reader([line]))))
            out.append((feed, *[row.get(c) or None for c in GTFS_COLUMNS[table]]))
    return out


@pytest.mark.parametrize("split_bytes", [64 << 20, 61, 8])
def test_rows_do_not_depend_on_the_splits(spark, tmp_path, split_bytes):
    registry = G.feed_registry(spark, write_feeds(str(tmp_path)))
    files = FF.read_feed_files(spark, registry, str(tmp_path), split_bytes)
    for table in GTFS_COLUMNS:
        got = [tuple(r) for r in getattr(files.tables, table).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, plain_rows(table)))
    assert files.rejects.count() == 0


def test_routes_equal_those_of_the_other_reader(spark, tmp_path):
    registry = G.feed_registry(spark, write_feeds(str(tmp_path)))
    files = FF.read_feed_files(spark, registry, str(tmp_path))
    other = G.read_feeds(spark, registry)
    for kind in ("night", "day"):
        a, b = (sorted(map(tuple, X.extract_routes(t, kind).collect())) for t in (files.tables, other))
        assert a == b and a


def test_gate_and_reasons(spark, tmp_path):
    feeds = write_feeds(str(tmp_path))
    bad = tmp_path / "bad"
    bad.mkdir()
    for name, text in FEEDS["A"].items():
        (bad / name).write_text(text.replace("stop_sequence", "seq"), encoding="utf-8")
    (tmp_path / "half").mkdir()
    for name, text in FEEDS["C"].items():  # endpoint columns in one of two part files alone
        folder = tmp_path / "half" / name
        folder.mkdir()
        (folder / "part-0.txt").write_text(text, encoding="utf-8")
        (folder / "part-1.txt").write_text(text.replace("end_stop_id", "other"), encoding="utf-8")
    feeds += [("bad", str(bad), "night", None), ("half", str(tmp_path / "half"), "day", None), ("none", str(tmp_path / "none"), "day", None)]
    files = FF.read_feed_files(spark, G.feed_registry(spark, feeds), str(tmp_path))
    reason = {r.feed_id: r.reason for r in files.inventory.collect()}
    assert reason == {
        "A": None, "B": None, "F": None, "C": None, "C-night": "missing files: stop_times.txt", "E": "missing files: routes.txt",
        "D": "neither stop_times nor endpoint columns", "half": "neither stop_times nor endpoint columns",
        "bad": "stop_times.txt has no column stop_sequence", "none": "no GTFS files",
    }
    assert files.tables.stops.where("feed_id = 'bad'").count() == 0 and files.tables.stops.where("feed_id = 'half'").count() == 8
    totals = {(r.level, r.kind): (r.feeds, r.valid, r.invalid, r.with_missing) for r in FF.inventory_totals(
        files.inventory.withColumn("records", F.lit(0))).where("level <> 'feed'").collect()}
    assert totals == {("kind", "night"): (6, 3, 3, 2), ("kind", "day"): (4, 1, 3, 1), ("all", None): (10, 4, 6, 3)}


@pytest.mark.parametrize("split_bytes", [64 << 20, 16])
def test_lines_that_are_no_records_are_kept_apart(spark, tmp_path, split_bytes):
    lines = [
        b'1,"A, ""b""",1.0,2.0', b"2,x,1.0", b"3,x,1.0,2.0,9", b'4,"broken', b'off",1.0,2.0', b"", b'5,"",,', b"6,\xff\xfe,1,2\r", b'7,"a",1,2,"b"',
        b"8,\xe4\xb8\xad\xe6\x96\x87,1,2",
    ]
    (tmp_path / "f").mkdir()
    text = b"\xef\xbb\xbfstop_id, stop_name,stop_lat,stop_lon\n" + b"\n".join(lines)
    (tmp_path / "f" / "stops.txt").write_bytes(text)
    files = FF.read_feed_files(spark, G.feed_registry(spark, [("f", str(tmp_path / "f"), "night")]), str(tmp_path), split_bytes)
    good = sorted(tuple(r) for r in files.tables.stops.collect())
    assert good == [
        ("f", "1", 'A, "b"', "1.0", "2.0"), ("f", "5", "", None, None), ("f", "6", "��", "1", "2"), ("f", "8", "中文", "1", "2"),
    ]
    bad = {r.offset: (r.reason, r.record) for r in files.rejects.collect()}
    assert {text[o:].split(b"\n")[0].rstrip(b"\r").decode(): reason for o, (reason, _) in bad.items()} == {
        "2,x,1.0": FF.TOO_FEW, "3,x,1.0,2.0,9": FF.TOO_MANY, '4,"broken': FF.OPEN_QUOTE, 'off",1.0,2.0': FF.OPEN_QUOTE, '7,"a",1,2,"b"': FF.TOO_MANY,
    }
    assert all(text[o:].split(b"\n")[0].decode() == record for o, (_, record) in bad.items())
    assert len(good) + len(bad) == sum(map(bool, lines))


def test_jobs_do_not_grow_with_the_feeds(spark, tmp_path):
    def jobs(n):
        root = tmp_path / str(n)
        feeds = []
        for i in range(n):
            (root / f"f{i}").mkdir(parents=True)
            for name, text in FEEDS["AB"[i % 2]].items():
                (root / f"f{i}" / name).write_text(text, encoding="utf-8")
            feeds.append((f"f{i}", str(root / f"f{i}"), "night", None))
        registry = G.feed_registry(spark, feeds)
        spark.sparkContext.setJobGroup(f"feeds-{n}", "")
        files = FF.read_feed_files(spark, registry, str(root))
        rows = files.tables.stop_times.count()
        ids = spark.sparkContext.statusTracker().getJobIdsForGroup(f"feeds-{n}")
        spark.sparkContext.setJobGroup("other", "")
        return len(ids), rows

    few, rows = jobs(4)
    many, more = jobs(120)
    assert more == 30 * rows and many <= few + 1  # a listing of many folders is a job of its own


def test_an_empty_registry_and_empty_files(spark, tmp_path):
    (tmp_path / "e").mkdir()
    for name in ("stops.txt", "trips.txt", "routes.txt", "stop_times.txt"):
        (tmp_path / "e" / name).write_text("")
    files = FF.read_feed_files(spark, G.feed_registry(spark, [("e", str(tmp_path / "e"), "night")]), str(tmp_path))
    assert files.inventory.first().reason == "no GTFS files"  # a file without a byte counts as absent
    assert all(getattr(files.tables, t).count() == 0 for t in GTFS_COLUMNS) and files.rejects.count() == 0


def test_ledger_adds_up_and_ends_where_the_extraction_does(spark, tmp_path):
    registry = G.feed_registry(spark, write_feeds(str(tmp_path)))
    tables = G.read_feeds(spark, registry)
    for kind in ("night", "day"):
        rows = {r.feed_id: r for r in X.feed_ledger(tables, kind).collect()}
        assert all(r.patterns == r.flt1 + r.flt2 + r.ded1 + r.ded2 + r.kept for r in rows.values())
        assert all(min(r.flt1, r.flt2, r.ded1, r.ded2, r.kept) >= 0 for r in rows.values())
        per_feed = {r.feed_id: r["count"] for r in X.feed_routes(tables, kind).groupBy("feed_id").count().collect()}
        assert {f: r.patterns - r.flt1 - r.flt2 - r.ded1 for f, r in rows.items() if per_feed.get(f)} == per_feed
        assert sum(r.kept for r in rows.values()) == X.extract_routes(tables, kind).count()
        assert set(rows) == {f for f, _, k, _ in REGISTRY if k == kind}
    night = {r.feed_id: r for r in X.feed_ledger(tables, "night").collect()}
    assert night["A"].flt1 == 2 and night["A"].flt2 == 1  # a blank name, an unknown stop; a latitude that is no number
    assert night["E"].patterns == 0 and X.with_drop_rule(tables, "night").where("rule IS NULL").count() >= 1


def test_ledger_of_the_views_has_drops(spark):
    rows = X.feed_ledger(V.gtfs(spark, SF), "day", V.DRIVER_STATION_MAP).collect()
    assert sum(r.flt2 for r in rows) > 0 and sum(r.ded1 for r in rows) > 0


@pytest.mark.parametrize("kind", ["night", "day", None])
def test_tables_of_feeds_do_not_pass_through_the_driver(spark, tmp_path, kind):
    """The planner cannot guess their size before they run, so no join with them is a broadcast."""
    registry = G.feed_registry(spark, write_feeds(str(tmp_path)))
    for tables in (FF.read_feed_files(spark, registry, str(tmp_path)).tables, G.read_feeds(spark, registry)):
        for df in (X.extract_routes(tables, kind), X.feed_ledger(tables, kind)):
            df.collect()  # final adaptive plan
            plan = df._jdf.queryExecution().executedPlan().toString()
            keys = re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan)
            assert keys and not [k for k in keys if re.search("trip_id|route_id|stop_id", k)]


def test_memory_of_a_task_does_not_grow_with_the_file(tmp_path):
    """Lines are parsed some at a time: a task holds a small part of a file of many megabytes."""
    file = tmp_path / "stop_times.txt"
    with open(file, "wb") as out:
        out.write(b"trip_id,stop_id,stop_sequence\n")
        for i in range(600_000):
            out.write(b"%d,%d,%d\n" % (i // 9, i * 7919 % 9973, i % 9))
    size, begins = file.stat().st_size, 30
    tracemalloc.start()
    try:
        n = sum(len(good) for offset, lines in FF._lines(str(file), begins, size, begins)
                for good, bad in [FF._judged(str(file), offset, lines, 3)])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 600_000 and peak < 2 * size
