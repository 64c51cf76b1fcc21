"""Session helpers.

Library functions never create a session; the caller owns it.  These helpers
exist for tests, the benchmark and the command line, and for one cluster
concern: where to cut lineage.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for this workload.  AQE stays on so that shuffle
# partition counts follow the real data size and skewed join partitions are
# split at run time; broadcast decisions use Spark's own size statistics.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


# Suggested settings for a large cluster run (e.g. ~100 TB of stop times on
# ~1000 executors); pass them with spark-submit --conf.  Shuffle partition
# counts start high and AQE coalesces them to ~256 MB each; scans split files
# into 256 MB tasks; skewed join partitions (a hub stop) are split.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "railtrace") -> SparkSession:
    """A local session for tests and benchmarks (not for cluster jobs)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("RAILTRACE_DRIVER_MEMORY", "8g"))
    )
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, object
    store) and is taken as is.  Only where nothing is configured and the master is
    local (tests) a fresh scratch folder is created; executors of a cluster would not
    share it, so there the setting is required.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="railtrace-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current
