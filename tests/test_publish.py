"""Staged publish: a failed run keeps the last good output, a rerun starts where the input changed."""

import datetime as dt

import pytest

from railtrace.operators import impact as I
from railtrace.plans.pipeline import run_pipeline
from railtrace.sinks.publish import StagedRun, fingerprints, listing_fingerprint
from railtrace.sources.gtfs import feed_registry, read_feeds
from tests.gtfs_fixture import write_feeds


def test_fingerprint_is_of_the_rows(spark):
    rows = [(1, "a"), (2, None), (2, None), (None, "a")]
    make = lambda r: spark.createDataFrame(r, "k int, s string")
    got = fingerprints({
        "one": make(rows), "turned": make(rows[::-1]).repartition(3), "once": make(rows[:2] + rows[3:]),
        "other": make(rows[:3] + [(None, "b")]), "empty": make([]), "renamed": make([]).withColumnRenamed("s", "t"),
        "left": make([(None, "1")]).select("s", "k").toDF("k", "s"), "right": make([(1, None)]).selectExpr("CAST(s AS STRING) k", "CAST(k AS STRING) s"),
    })
    assert got["one"] == got["turned"]
    assert len(set(got.values())) == len(got) - 1
    assert fingerprints({}) == {}


def test_listing_fingerprint_follows_the_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    first = listing_fingerprint(spark, [str(tmp_path)])
    assert listing_fingerprint(spark, [str(tmp_path)]) == first
    (tmp_path / "b.txt").write_text("x")
    both = listing_fingerprint(spark, [str(tmp_path)])
    assert both != first and listing_fingerprint(spark, [str(tmp_path), str(tmp_path / "gone")]) == both
    listing_fingerprint(spark, [str(tmp_path / "gone")])


def stages(spark, root, n, fail=None, again=()):
    """Two datasets, the second from the first; ``fail`` raises in place of the second."""
    source = spark.range(n)
    run = StagedRun(spark, str(root), inputs=fingerprints({"source": source}))
    made = []

    def build(name, df):
        made.append(name)
        if name == fail:
            raise RuntimeError("lost")
        return df

    a = run.stage("a", lambda: build("a", source.selectExpr("id % 3 AS k")), ["source"])
    run.stage("b", lambda: build("b", a.distinct()), ["a"], list(again))
    return run, made


def published(spark, root, name):
    return sorted(r.k for r in spark.read.parquet(f"{root}/{name}").collect())


def test_failure_before_and_after_the_journal(spark, tmp_path, monkeypatch):
    run, made = stages(spark, tmp_path, 2)
    out = run.publish()
    assert made == ["a", "b"] and run.rows == {"a": 2, "b": 2} and sorted(r.k for r in out["b"].collect()) == [0, 1]
    with pytest.raises(RuntimeError):
        stages(spark, tmp_path, 7, fail="b")
    assert published(spark, tmp_path, "a") == published(spark, tmp_path, "b") == [0, 1]  # the last good output
    run, made = stages(spark, tmp_path, 7)
    assert made == ["b"] and run.reused == ["a"]  # resumed after the stage that stood

    moves = []

    def broken(self, source, target, move=StagedRun._move):
        moves.append(target.toString())
        if len(moves) > 3:  # the journal's own, a's folder and record
            raise OSError("lost")
        move(self, source, target)

    monkeypatch.setattr(StagedRun, "_move", broken)
    with pytest.raises(OSError):
        run.publish()
    monkeypatch.undo()
    run, made = stages(spark, tmp_path, 7)  # opening the folder ends that publish
    assert made == [] and run.reused == ["a", "b"]
    assert published(spark, tmp_path, "a") == [0, 0, 0, 1, 1, 2, 2] and published(spark, tmp_path, "b") == [0, 1, 2]
    assert not (tmp_path / "_journal.json").exists() and not (tmp_path / "_staging").exists()


def test_stage_runs_for_a_new_input_or_parameter_alone(spark, tmp_path):
    stages(spark, tmp_path, 7)[0].publish()
    assert stages(spark, tmp_path, 7)[1] == []
    assert stages(spark, tmp_path, 7, again=[1])[1] == ["b"]
    (tmp_path / "_commits" / "a.json").unlink()  # a folder without its record, but the same rows come out
    assert stages(spark, tmp_path, 7)[1] == ["a"]
    run, made = stages(spark, tmp_path, 0)
    assert made == ["a", "b"] and run.rows == {"a": 0, "b": 0}
    assert {k: v.count() for k, v in run.publish().items()} == {"a": 0, "b": 0}


def test_pipeline_fails_midway_and_resumes(spark, tmp_path, monkeypatch):
    root, out = tmp_path / "feeds", str(tmp_path / "out")
    feeds = write_feeds(str(root))
    go = lambda: run_pipeline(spark, read_feeds(spark, feed_registry(spark, feeds)), out, calculation_date=dt.date(2024, 1, 1))
    first = go()
    assert first.reused == []
    before = sorted(map(tuple, spark.read.parquet(f"{out}/night_routes").collect()))

    stops = root / "B" / "stops.txt"
    stops.write_text(stops.read_text(encoding="utf-8").replace("Venice Santa Lucia", "Verona Porta Nuova"), encoding="utf-8")

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(I, "environmental_impact", lost)
    with pytest.raises(RuntimeError):
        go()
    monkeypatch.undo()
    assert sorted(map(tuple, spark.read.parquet(f"{out}/night_routes").collect())) == before
    resumed = go()
    # day routes came out the same, so what follows from them alone stands since the first run
    assert {"night_routes", "day_routes", "day_routes_cleaned", "quality_day", "all_routes_cleaned"} <= set(resumed.reused)
    assert "environmental_impact" not in resumed.reused
    after = sorted(map(tuple, spark.read.parquet(f"{out}/night_routes").collect()))
    assert after != before and any("verona" in r.origin or "verona" in r.destination for r in resumed.outputs["night_routes"].collect())
    assert all(r.exists and r.duplicate_keys == 0 for r in resumed.manifest.collect())
    assert resumed.step_rows == {k: v.count() for k, v in resumed.outputs.items()}
