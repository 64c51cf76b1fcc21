"""Writers (SNK1-SNK3).

Parquet by default (lossless: an empty string stays empty, decimals stay
decimals); CSV with a header on request.  Writes are parallel -- one file per
task -- and ``single_file`` coalesces to one task only when a caller really
needs one file (the reference always does, which serializes the write).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


# SNK1 extracted routes, SNK2 cleaned routes (folders are created by the
# writer; an empty result is visible in the manifest), SNK3 emission tables.
def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    single_file: bool = False,
) -> None:
    """Write ``df`` to ``path``.  ``partition_by`` (e.g. ``["type"]``) lets
    later reads prune whole folders."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def read_back(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A table that ``write_table`` wrote, with the types it had."""
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        # a folder column is not in the files, so columns go by the header
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.load(path).select(*schema.names)
