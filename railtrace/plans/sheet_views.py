"""The sheet views of the test tables as files below the shared folder, in several parts each.

Sheet order is the files' order by name and the lines' order in a file; no column holds it.  The
mode sheet is CSV with a header in every file; the flights sheet has three lines and its header
before the first row, in the first file alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtrace.plans import driver_views as V
from railtrace.schemas import FLIGHT_SHEET_COLUMNS
from railtrace.session import ensure_checkpoint_dir

PARTS = 5  # files of a sheet
PREAMBLE = ["Flights 2019", "all figures per year", ""]


def _in_order(df: DataFrame) -> DataFrame:
    return df.repartitionByRange(PARTS, "ord").sortWithinPartitions("ord").drop("ord")


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheet-{uuid.uuid4().hex}"


def write_mode_sheet(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the mode sheet's files."""
    path = _folder(spark)
    writer = _in_order(V.mode_sheet(spark, sf_dir)).write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def write_flight_sheet(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the flights sheet's files."""
    path = _folder(spark)
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in FLIGHT_SHEET_COLUMNS]
    rows = V.flight_sheet(spark, sf_dir).select(F.col("ord").cast("long").alias("ord"), F.concat_ws(",", *cells).alias("line"))
    head = [*PREAMBLE, ",".join(FLIGHT_SHEET_COLUMNS)]
    first = spark.createDataFrame([(i - len(head), line) for i, line in enumerate(head)], "ord long, line string")
    _in_order(first.unionByName(rows)).write.text(path)
    return path
