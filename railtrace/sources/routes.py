"""Readers for written route tables (SRC8, SRC9).

Normally the steps hand DataFrames to each other in memory; these readers
exist for runs that start from written outputs.  Schemas are explicit, so a
text column never turns into a number and ids never lose leading zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtrace.schemas import CLEAN_COLUMNS, CLEANED_ROUTES, EXTRACTED_ROUTES, ROUTE_COLUMNS


def _read(spark: SparkSession, path: str, schema, fmt: str) -> DataFrame:
    if fmt == "csv":
        # header + enforceSchema=false: columns are matched by name and a
        # file whose header disagrees fails instead of shifting columns
        return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return spark.read.format(fmt).load(path).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def read_extracted_routes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC8: the eight extracted-route columns."""
    return _read(spark, path, EXTRACTED_ROUTES, fmt).select(*ROUTE_COLUMNS)


def read_cleaned_routes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC9: cleaned routes (eight columns + ``type``)."""
    return _read(spark, path, CLEANED_ROUTES, fmt).select(*CLEAN_COLUMNS)
