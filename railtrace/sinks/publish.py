"""Staged publish and restart of a run's datasets (SNK1-SNK3, OPS17).

A run writes its datasets below ``<root>/_staging``; ``<root>/<dataset>`` holds what the last
whole run published, and stays as it is until every stage of the new run stands.  Then the
run writes a journal (the names to publish) and moves the staged folders into place.  A run that fails
before the journal changes nothing that readers see; one that fails after it is carried to
its end by whoever opens the folder next.

Every dataset has a record (``_commits``, or ``_staging/_commits`` until it is published): a key, made of
what the stage reads and its parameters, and the fingerprint of its rows.  A stage whose key is on
record is not run: its dataset is read as it stands.  What a stage reads is known by
fingerprint, so a rerun starts at the first stage whose input changed and stops where the
rows come out the same: a feed that gives the same routes leaves every later dataset alone.

A fingerprint is the row count and the sums of two 64-bit hashes of the rows, whatever their order and
partitions.  That of a dataset is observed on the write that makes it, without another pass; those of
a run's inputs cost one scan of them, or none where the caller names a cheaper one
(``listing_fingerprint``: paths, sizes and times of files).

Bounds and odd cases: one run at a time per ``root``; moves are renames, atomic in HDFS and local
folders, while an object store copies; between the moves readers may see datasets of both runs.
The driver touches file names and records alone, one of each per dataset.  An empty dataset has
a fingerprint like any other; a record without its folder, or a folder without its record, counts as
absent.  Changes of the library's code are seen through its version.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from railtrace import __version__
from railtrace.sinks.writers import read_back, write_table

STAGING, COMMITS, JOURNAL = "_staging", "_commits", "_journal.json"


def _sums(df: DataFrame) -> list[Column]:
    """The aggregates of a fingerprint.  Hashes skip nulls, so the places of nulls are hashed too."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    parts = [*cols, *[c.isNull() for c in cols]]
    total = [F.coalesce(F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")) for seed in (1, 2)]
    return [F.count(F.lit(1)).alias("rows"), total[0].alias("sum1"), total[1].alias("sum2")]


def _shown(names: Sequence[str], values: Mapping) -> str:
    return _digest([list(names), *[str(values.get(k) or 0) for k in ("rows", "sum1", "sum2")]])


def fingerprints(datasets: Mapping[str, DataFrame]) -> dict[str, str]:
    """The fingerprint of each dataset; one job, whose result has a row per dataset."""
    if not datasets:
        return {}
    rows = None
    for name, df in datasets.items():
        one = df.agg(*_sums(df)).withColumn("dataset", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    return {r["dataset"]: _shown(datasets[r["dataset"]].columns, r.asDict()) for r in rows.collect()}


def listing_fingerprint(spark: SparkSession, paths: Sequence[str], pattern: str = "*.txt") -> str:
    """The fingerprint of the files below ``paths``: their names, sizes and times, without reading them.
    A path that does not exist counts for nothing."""
    conf = spark._jsc.hadoopConfiguration()
    folders = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    paths = [p for p, folder in zip(paths, folders) if folder.getFileSystem(conf).exists(folder)]
    if not paths:
        return _digest([])
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(paths)
    return fingerprints({"files": listed.select("path", "length", "modificationTime")})["files"]


def _digest(parts) -> str:
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


class StagedRun:
    """The stages of one run over ``root``; opening it ends a publish that was broken off."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", inputs: Mapping[str, str] | None = None):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self.content = dict(inputs or {})  # fingerprint of each input and of each dataset so far
        self.records: dict[str, dict] = {}
        self.reused: list[str] = []
        self._files = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self._end_publish()

    def stage(self, name: str, build: Callable[[], DataFrame], reads: Sequence[str], given=(), partition_by: Sequence[str] | None = None) -> DataFrame:
        """The dataset ``name``, from its folder.  ``build`` makes it from what ``reads`` names (inputs or
        stages) and the parameters ``given`` (any value that JSON can hold); it is called only if no
        folder on record was made from the same."""
        key = _digest([__version__, name, self.fmt, [self.content[r] for r in reads], given, list(partition_by or ())])
        for base in ("", STAGING):
            record = self._record(base, name)
            if record and record["key"] == key and self._files.exists(self._path(base, name)):
                self.reused.append(name)
                break
        else:
            base, record = STAGING, self._write(name, build(), key, partition_by)
        self.records[name] = record | {"base": base}
        self.content[name] = record["content"]
        return self._read(name)

    def publish(self) -> dict[str, DataFrame]:
        """Move what was staged into place; every dataset of the run, from where it now is."""
        staged = [name for name, record in self.records.items() if record["base"] == STAGING]
        self._put(self._path(JOURNAL), json.dumps(staged))
        self._end_publish()
        for record in self.records.values():
            record["base"] = ""
        return {name: self._read(name) for name in self.records}

    @property
    def rows(self) -> dict[str, int]:
        return {name: record["rows"] for name, record in self.records.items()}

    def _write(self, name: str, df: DataFrame, key: str, partition_by) -> dict:
        self._drop(self._path(STAGING, COMMITS, f"{name}.json"))  # no record while the folder is written
        seen = Observation(name)
        write_table(df.observe(seen, *_sums(df)), f"{self.root}/{STAGING}/{name}", self.fmt, partition_by=partition_by)
        record = {"key": key, "content": _shown(df.columns, seen.get), "rows": seen.get.get("rows", 0), "schema": df.schema.json()}
        self._put(self._path(STAGING, COMMITS, f"{name}.json"), json.dumps(record))
        return record

    def _read(self, name: str) -> DataFrame:
        record = self.records[name]
        folder = "/".join(p for p in (self.root, record["base"], name) if p)
        return read_back(self.spark, folder, StructType.fromJson(json.loads(record["schema"])), self.fmt)

    def _end_publish(self) -> None:
        """Carry out the journal, if there is one.  Each step may have been done before."""
        if not self._files.exists(self._path(JOURNAL)):
            return
        self._files.mkdirs(self._path(COMMITS))
        for name in json.loads(self._get(self._path(JOURNAL))):
            for parts in ((name,), (COMMITS, f"{name}.json")):
                if self._files.exists(self._path(STAGING, *parts)):
                    self._drop(self._path(*parts))
                    self._move(self._path(STAGING, *parts), self._path(*parts))
        self._drop(self._path(STAGING))
        self._drop(self._path(JOURNAL))

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *[p for p in parts if p]]))

    def _record(self, base: str, name: str) -> dict | None:
        path = self._path(base, COMMITS, f"{name}.json")
        return json.loads(self._get(path)) if self._files.exists(path) else None

    def _get(self, path) -> str:
        stream = self._files.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, path, text: str) -> None:
        """A small file, whole or not at all: written beside its place and moved there."""
        beside = path.suffix(".new")
        stream = self._files.create(beside, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        self._drop(path)
        self._move(beside, path)

    def _drop(self, path) -> None:
        if self._files.exists(path) and not self._files.delete(path, True):
            raise OSError(f"cannot delete {path.toString()}")

    def _move(self, source, target) -> None:
        if not self._files.rename(source, target):
            raise OSError(f"cannot move {source.toString()} to {target.toString()}")
