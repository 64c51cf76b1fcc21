"""Environmental impact per route and its summaries (OPS13, OPS14)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtrace.functions.arithmetic import kg_raw, kg_to_tons, ratio_half_up, round_kg

# Fixed value (must equal the reference's).
EMISSION_SOURCE = "Back-on-Track 2019"

SUM_KG = "decimal(38,2)"


def environmental_impact(routes: DataFrame, factors: DataFrame, calculation_date: dt.date | None = None) -> DataFrame:
    """OPS13: routes + factors -> kg of CO2 by train and plane, savings, percent.

    ``factors`` is the one-row result of ``emission_factors``; it is attached
    as a scalar subquery (evaluated once), not joined.  Kilograms are rounded
    from exact products; savings come from the unrounded values; the percent
    is null at distance 0 (SURVEY D5, D6).
    """
    if "distance_km" not in routes.columns:  # FLT8
        raise ValueError(f"routes have no 'distance_km' column: {routes.columns}")
    # JON8: the one-row factor table as a scalar subquery
    f = factors.select(F.struct("train_gco2_pkm", "plane_gco2_pkm").alias("f")).scalar()
    with_f = routes.select(
        "*",
        f.getField("train_gco2_pkm").alias("train_gco2_pkm"),
        f.getField("plane_gco2_pkm").alias("plane_gco2_pkm"),
    )
    train, plane = F.col("train_gco2_pkm"), F.col("plane_gco2_pkm")
    d = F.col("distance_km").cast("decimal(12,2)")
    t_raw, p_raw = kg_raw(d, train), kg_raw(d, plane)
    when = F.current_date() if calculation_date is None else F.lit(calculation_date)
    return with_f.select(
        "*",
        round_kg(t_raw).alias("train_co2_kg"),
        round_kg(p_raw).alias("plane_co2_kg"),
        round_kg(p_raw - t_raw).alias("co2_savings_kg"),  # SCL11: from unrounded values
        F.when(d != 0, ratio_half_up((plane - train) * F.lit(100), plane, 1)).alias("savings_percent"),
        F.lit(EMISSION_SOURCE).alias("emission_source"),  # PRJ4
        when.alias("calculation_date"),  # PRJ5
    )


def impact_totals(impact: DataFrame) -> DataFrame:
    """AGG9: one row.  Sums the already rounded per-route values, as the
    reference does; the mean per route is HALF_UP to cents."""
    s = impact.agg(
        F.count(F.lit(1)).alias("total_routes"),
        F.sum("train_co2_kg").cast(SUM_KG).alias("total_train_co2_kg"),
        F.sum("plane_co2_kg").cast(SUM_KG).alias("total_plane_co2_kg"),
        F.sum("co2_savings_kg").cast(SUM_KG).alias("total_co2_savings_kg"),
    )
    return s.select(
        "*",
        kg_to_tons("total_co2_savings_kg").alias("total_co2_savings_tons"),
        ratio_half_up(F.col("total_co2_savings_kg"), F.col("total_routes"), 2, scale=2)
        .cast("decimal(20,2)").alias("avg_savings_per_route_kg"),
    )


def _savings_by(impact: DataFrame, key: str) -> DataFrame:
    return (
        impact.filter(F.col(key).isNotNull())  # pandas groupby drops null keys
        .groupBy(key)
        .agg(
            F.count("origin").alias("route_count"),
            F.sum("co2_savings_kg").cast(SUM_KG).alias("co2_savings_kg"),
        )
        .withColumn("co2_savings_tons", kg_to_tons("co2_savings_kg"))
    )


def impact_by_country(impact: DataFrame) -> DataFrame:
    """AGG10: savings by origin country, every country."""
    return _savings_by(impact, "origin_country")


def top_countries(by_country: DataFrame, n: int = 10) -> DataFrame:
    """The printed part of AGG10: the countries with the largest savings."""
    return by_country.orderBy(F.col("co2_savings_kg").desc(), "origin_country").limit(n)


def impact_by_type(impact: DataFrame) -> DataFrame:
    """AGG11: savings by train type."""
    return _savings_by(impact, "type")


TOP_ROUTE_COLUMNS = ["origin", "destination", "origin_country", "destination_country", "distance_km", "co2_savings_kg"]


def top_routes(impact: DataFrame, n: int = 10) -> DataFrame:
    """TOP1: routes with the largest savings (nulls excluded); ties by a
    total order on the route key."""
    s = F.col("co2_savings_kg")
    return (
        impact.filter(s.isNotNull())
        .orderBy(s.desc(), "origin", "destination", "route_name", "type")
        .limit(n)
        .select(*TOP_ROUTE_COLUMNS)
    )
