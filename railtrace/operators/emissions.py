"""Emission reference tables (OPS8-OPS12).

Sheets arrive as exported tables (CSV/Parquet) with an explicit ``ord``
column giving sheet order; every "first matching row" rule is a ``min_by``
over ``ord``, so results do not depend on partitioning.  Scalar baselines
are attached with scalar subqueries (``DataFrame.scalar()``), not joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtrace.functions.arithmetic import factor, percent_saved
from railtrace.functions.text import strip_stars, to_number
from railtrace.schemas import FLIGHT_SHEET_COLUMNS

# Fixed values (must equal the reference's).
REFERENCE_SOURCE = "Back-on-Track"
REFERENCE_YEAR = 2019
DEFAULT_FACTORS = {"train": 14, "plane": 144, "car": 132}


def emission_reference(sheet: DataFrame) -> DataFrame:
    """OPS8: first three sheet columns (by position, after ``ord``) renamed,
    rows without a mode dropped, ``*`` removed, factors parsed."""
    c0, c1, c2 = [c for c in sheet.columns if c != "ord"][:3]
    # FLT4 mode present; SCL8 strip '*'; SCL9 numbers; PRJ4 source and year
    return sheet.filter(F.col(c0).isNotNull()).select(
        "ord",
        strip_stars(F.col(c0)).alias("transport_mode"),
        to_number(F.col(c1)).alias("gco2_per_pkm"),
        to_number(F.col(c2)).alias("gco2_per_pkm_rf3"),
        F.lit(REFERENCE_SOURCE).alias("source"),
        F.lit(REFERENCE_YEAR).alias("year"),
    )


def first_match(value: str, cond: str) -> Column:
    """Aggregate: ``value`` of the first row (by ``ord``) where ``cond`` holds
    (both SQL text).

    Wrapped in a struct so that "no row" (null) and "row with null value"
    (struct holding null) stay distinguishable (SURVEY D7)."""
    return F.expr(f"min_by(struct({value} AS v), CASE WHEN {cond} THEN ord END)")


def _contains(s: str, case: bool = True) -> str:
    """FLT6: substring test on the mode, case-sensitive or not (SQL text)."""
    lit = "'" + (s if case else s.lower()).replace("'", "''") + "'"
    return f"contains(transport_mode, {lit})" if case else f"contains(lower(transport_mode), {lit})"


def baselines(reference: DataFrame) -> DataFrame:
    """LKP2: first modes containing 'Plane' / 'Car' (case-sensitive); null
    when absent, null or zero."""
    return reference.agg(
        first_match("gco2_per_pkm", _contains("Plane")).v.alias("plane"),
        first_match("gco2_per_pkm", _contains("Car")).v.alias("car"),
    ).select(
        F.struct(
            F.nullif("plane", F.lit(0.0)).alias("plane"),
            F.nullif("car", F.lit(0.0)).alias("car"),
        ).alias("b")
    )


def emission_summary(reference: DataFrame) -> DataFrame:
    """OPS9: per mode with a factor, percent saved versus plane and car."""
    b = baselines(reference).scalar()  # JON9: scalar baselines, no cross join
    x = F.col("gco2_per_pkm")
    # FLT7 skips modes without a factor; SCL14 / SCL15 percents
    return reference.filter(x.isNotNull() & ~F.isnan(x)).select(
        "transport_mode",
        "gco2_per_pkm",
        percent_saved(b.getField("plane"), x).alias("vs_plane_savings_percent"),
        percent_saved(b.getField("car"), x).alias("vs_car_savings_percent"),
    )


def headline_saving(reference: DataFrame) -> DataFrame:
    """OPS11 (AGG12): night train versus plane, first rows containing
    'Night Train' and 'Plane'; no row when either is missing."""
    s = reference.agg(
        first_match("gco2_per_pkm", _contains("Night Train")).alias("t"),
        first_match("gco2_per_pkm", _contains("Plane")).alias("p"),
    ).filter(F.col("t").isNotNull() & F.col("p").isNotNull())
    return s.select(
        F.col("t.v").alias("night_train_gco2_pkm"),
        F.col("p.v").alias("plane_gco2_pkm"),
        percent_saved(F.col("p.v"), F.col("t.v")).alias("savings_percent"),
    )


def emission_factors(reference: DataFrame | None, spark: SparkSession | None = None) -> DataFrame:
    """OPS12 (LKP1): train / plane / car factors as one row of DECIMAL(12,6).

    train: first mode containing 'night train' (any case); plane: mode equal
    to 'Plane'; car: first containing 'car' (any case).  A missing mode takes
    its default; a matching row with a null factor stays null (SURVEY D7).
    Without a reference table at all, every factor is its default.
    """
    if reference is None:
        return spark.range(1).select(
            *[factor(F.lit(v)).alias(f"{k}_gco2_pkm") for k, v in DEFAULT_FACTORS.items()]
        )
    conds = {
        "train": _contains("Night Train", case=False),
        "plane": "transport_mode = 'Plane'",
        "car": _contains("Car", case=False),
    }
    firsts = reference.agg(*[first_match("gco2_per_pkm", c).alias(k) for k, c in conds.items()])
    return firsts.selectExpr(*[
        f"try_cast(CASE WHEN {k} IS NULL THEN {float(DEFAULT_FACTORS[k])}D ELSE {k}.v END AS DECIMAL(12,6)) AS {k}_gco2_pkm"
        for k in conds
    ])


def flight_routes(sheet: DataFrame, sample_size: int = 100) -> DataFrame:
    """OPS10: flights replaceable by trains -- the first ``sample_size`` rows
    (sheet order) with both cities, numbers parsed, savings = aviation - train."""
    df = sheet.select("ord", *[F.col(f"`{src}`").alias(dst) for src, dst in FLIGHT_SHEET_COLUMNS.items()])
    df = df.filter(F.col("origin_city").isNotNull() & F.col("destination_city").isNotNull())  # FLT5
    # numbers are parsed in the sample alone; in one projection, as with a second one between limit and
    # sort Spark would sort all flights instead of keeping each task's first ones
    numbers = {c: to_number(F.col(c)) for c in list(FLIGHT_SHEET_COLUMNS.values())[2:]}
    saved = numbers["aviation_emissions_tco2e"] - numbers["train_emissions_tco2e"]  # SCL16
    return df.orderBy("ord").limit(sample_size).withColumns(numbers | {"co2_savings_tco2e": saved})


def top_flights(sample: DataFrame, n: int = 5) -> DataFrame:
    """TOP2: largest savings within the sample; ties keep sheet order."""
    s = F.col("co2_savings_tco2e")
    return (
        sample.filter(s.isNotNull() & ~F.isnan(s))
        .orderBy(s.desc(), F.col("ord"))
        .limit(n)
        .select("origin_city", "destination_city", "passengers_2019", "co2_savings_tco2e")
    )
