"""Emission sheets exported to CSV or Parquet (SRC10-SRC12).

The reference reads an ODS workbook with pandas; spreadsheet decoding is a
single-machine parser and is not rebuilt here (README, "Not built").  The
sheets arrive as exported tables and are read as text; every reader adds an
``ord`` column that keeps sheet order, because "first matching row" rules
(LKP1, LKP2, TOP3) depend on it.
"""

from __future__ import annotations

import csv
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtrace.schemas import FLIGHT_SHEET_COLUMNS


def _with_order(df: DataFrame) -> DataFrame:
    """Sheet order as ``ord``: by file name, then by position in the file.

    Applied directly after the scan.  Spark deals splits to tasks by size, so
    a row's place is the rank of its split (few: one row each) and its place
    in the split, which the increasing id within a task follows."""
    placed = df.select(
        F.col("_metadata.file_path").alias("_0"), F.col("_metadata.file_block_start").alias("_1"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"), "*",
    )
    splits = placed.select("_0", "_1").distinct().orderBy("_0", "_1").collect()
    ranks = df.sparkSession.createDataFrame(
        [(*s, i) for i, s in enumerate(splits)], "_0 string, _1 long, _rank long"
    )
    return placed.join(F.broadcast(ranks), ["_0", "_1"]).select(
        (F.shiftleft("_rank", 33) + F.col("_row")).alias("ord"), *[F.col(f"`{c}`") for c in df.columns]
    )


def read_sheet(spark: SparkSession, path: str, fmt: str = "csv", header: bool = True, skip_rows: int = 0) -> DataFrame:
    """A sheet as text columns plus ``ord``.

    ``skip_rows`` drops preamble lines before the header (the flights sheet
    has three).  CSV is read without inference."""
    if fmt != "csv":
        df = spark.read.format(fmt).load(path)
        return df if "ord" in df.columns else _with_order(df)
    if skip_rows == 0:
        return _with_order(spark.read.option("header", header).option("inferSchema", False).csv(path))
    lines = _with_order(spark.read.text(path))
    # preamble + header: the first ``skip_rows + 1`` lines (a bounded top-k)
    head = lines.orderBy("ord").limit(skip_rows + 1).collect()
    cut, header_line = head[-1]["ord"], head[-1]["value"]
    names = [c.strip() for c in next(csv.reader([header_line]))]
    body = lines.filter(F.col("ord") > cut)
    parsed = F.from_csv(F.col("value"), ", ".join(f"`{n}` STRING" for n in names))
    return body.select("ord", parsed.alias("r")).select("ord", "r.*")


def mode_sheet(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """SRC11: the mode sheet; ``emission_reference`` takes its first three
    columns by position."""
    return read_sheet(spark, path, fmt)


def flight_sheet(spark: SparkSession, path: str, fmt: str = "csv", skip_rows: int = 3) -> DataFrame:
    """SRC12: the flights sheet with the seven named columns (and ``ord``)."""
    df = read_sheet(spark, path, fmt, skip_rows=skip_rows)
    missing = [c for c in FLIGHT_SHEET_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"flights sheet lacks columns {missing}")
    return df.select("ord", *[F.col(f"`{c}`") for c in FLIGHT_SHEET_COLUMNS])


def emission_reference_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """SRC10: a written emission reference; None, with a warning, when there is
    none, so that ``emission_factors`` falls back to its defaults (SURVEY D8).
    Any other fault (a permission, a corrupt file) is raised."""
    try:
        df = spark.read.format(fmt).option("header", True).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"no emission reference at {path}: default factors are used", stacklevel=2)
        return None
    if "ord" not in df.columns:
        df = _with_order(df)
    return df.select(
        "ord",
        F.col("transport_mode").cast("string"),
        F.col("gco2_per_pkm").try_cast("double").alias("gco2_per_pkm"),
    )
