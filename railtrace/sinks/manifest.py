"""Output manifest (SNK4 / OPS16): what was written, and is it sound?

The reference prints, for each expected output file, whether it exists and
its size.  Here the check is re-aimed at the data: for each dataset, whether
files exist, their bytes, the row count and the number of key values that
occur more than once.  Every number is computed by Spark; only the file
listing (one row per dataset) is looked at on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dataset_audit(datasets: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per dataset: ``dataset, rows, duplicate_keys``.

    ``duplicate_keys`` counts key values (nulls are values) held by more than one row.
    Hash, then confirm: one aggregate over (dataset, 64-bit hash of the key) counts the rows of
    all datasets, so what is shuffled of a key is its hash; only rows whose hash is on more
    than one row give their exact keys, and those are counted.  Two keys of one hash are
    thus told apart, and a sound dataset never shuffles a key."""
    spark = next(iter(datasets.values()))[0].sparkSession
    keyed = None
    for name, (df, keys) in datasets.items():
        # length and text of each part, "-" for null: equal texts are equal keys
        parts = [f"coalesce(concat(length(CAST(`{k}` AS STRING)), ':', CAST(`{k}` AS STRING)), '-')" for k in keys]
        rows = df.select(F.lit(name).alias("dataset"), _hash(keys).alias("hash"), F.expr(f"concat({', '.join(parts)})").alias("key"))
        keyed = rows if keyed is None else keyed.unionByName(rows)
    per_hash = keyed.groupBy("dataset", "hash").agg(F.count(F.lit(1)).alias("n"))
    rows = per_hash.groupBy("dataset").agg(F.sum("n").alias("rows"))
    twice = per_hash.where("n > 1").select("dataset", "hash")
    exact = keyed.join(twice, ["dataset", "hash"], "left_semi").groupBy("dataset", "key").agg(F.count(F.lit(1)).alias("n"))
    duplicates = exact.groupBy("dataset").agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"))
    names = spark.createDataFrame([(name,) for name in datasets], "dataset string")
    return names.join(rows, "dataset", "left").join(duplicates, "dataset", "left").select(
        "dataset", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce("duplicate_keys", F.lit(0)).cast("bigint").alias("duplicate_keys"),
    )


def _hash(keys: Sequence[str]):
    """The hash of a key that ``dataset_audit`` counts first."""
    return F.xxhash64(*keys)


def output_manifest(
    spark: SparkSession,
    root: str,
    expected: Mapping[str, Sequence[str]],
    fmt: str = "parquet",
) -> DataFrame:
    """Manifest of datasets written under ``root`` (one sub-folder each).

    ``expected`` maps dataset name -> key columns.  Columns: dataset, exists,
    bytes, rows, duplicate_keys (rows and duplicate_keys are null for missing
    datasets)."""
    root = root.rstrip("/")
    conf = spark._jsc.hadoopConfiguration()
    listed = []  # one row per expected dataset, asked of its file system
    for name in expected:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        fs = folder.getFileSystem(conf)
        summary = fs.getContentSummary(folder) if fs.exists(folder) else None
        files = summary.getFileCount() if summary else 0
        listed.append((name, files > 0, summary.getLength() if summary else 0))
    present = {name for name, exists, _ in listed if exists}
    audited = {
        name: (spark.read.format(fmt).option("header", True).load(f"{root}/{name}"), keys)
        for name, keys in expected.items() if name in present
    }
    out = spark.createDataFrame(listed, "dataset string, exists boolean, bytes long")
    if audited:
        out = out.join(dataset_audit(audited), "dataset", "left")
    else:
        out = out.withColumn("rows", F.lit(None).cast("bigint")).withColumn("duplicate_keys", F.lit(None).cast("bigint"))
    return out.orderBy("dataset")
