"""Helpers shared by the operators: shared-folder tables, quoting, Arrow rows."""

from __future__ import annotations

import uuid
import weakref
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from railtrace.session import ensure_checkpoint_dir


_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()  # of tables that were written


def q(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, *more: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors.

    The rows of ``more`` follow, one job each.  A job's shuffle files go when it ends;
    else they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        for part in (df, *more):
            part.write.mode("append").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def discard(written_table: DataFrame) -> None:
    """Delete the files of a table made by ``written``, which nothing reads any more."""
    spark = written_table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(written_table))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def map_batches(df: DataFrame, run, added: str) -> DataFrame:
    """``mapInArrow`` by column place, for any column names; ``added`` is DDL of columns that ``run`` appends."""
    more = StructType.fromDDL(added).fields if added else []
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    fields = [StructField(n, f.dataType, True) for n, f in zip(plain.columns, df.schema)]
    return plain.mapInArrow(run, StructType(fields + more)).toDF(*df.columns, *[f.name for f in more])


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the jobs that run inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def batch_bytes(spark: SparkSession, most: int):
    """Arrow batches of at most about so many bytes, for a job that runs inside the block.

    The default bounds a batch by rows alone; long texts would make it any size.
    """
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
