"""The end-to-end run (OPS17): feeds + sheets -> every output dataset.

Order as in the reference: extract night and day routes, build the emission
reference and summary (and the optional flight sample), clean and combine
routes, then compute the environmental impact and its summaries.

Night and day routes are extracted by one chain of joins (``extracted_routes``, an
intermediate dataset beside the outputs) and told apart when it is read back.

Each stage is written and read back before the next stage
uses it.  That cuts lineage: the extraction is computed once although six
later datasets depend on it, and a stage that loses an executor recomputes
from the files of the stage before.  ``sinks.publish`` keeps the last good
output of ``out_dir`` until the whole run stands, and skips the stages whose
input has not changed since they were written.
``out_dir`` must be a shared folder on a cluster.
Row counts at the stage borders come from ``observe`` on those same writes
(AGG7), so counting costs no extra pass.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtrace.operators import clean as C
from railtrace.operators import emissions as E
from railtrace.operators import extract as X
from railtrace.operators import impact as I
from railtrace.sinks.manifest import output_manifest
from railtrace.sinks.publish import StagedRun, fingerprints
from railtrace.sources.gtfs import GtfsTables

# Keys that must be unique in each output (checked by the manifest).
OUTPUT_KEYS = {
    "night_routes": ["origin", "destination", "route_name"],
    "day_routes": ["origin", "destination", "route_name"],
    "night_routes_cleaned": ["origin", "destination", "route_name"],
    "day_routes_cleaned": ["origin", "destination", "route_name"],
    "all_routes_cleaned": ["origin", "destination", "route_name"],
    "emissions_reference": ["ord"],
    "emissions_summary": ["transport_mode", "gco2_per_pkm"],
    "environmental_impact": ["origin", "destination", "route_name"],
    "impact_totals": ["total_routes"],
    "impact_by_country": ["origin_country"],
    "impact_by_country_top10": ["origin_country"],
    "unresolved_day": ["origin", "destination"],
    "night_by_country": ["origin_country"],
    "day_by_country": ["origin_country"],
    "routes_by_country": ["origin_country"],
    "routes_by_type": ["type"],
    "routes_by_country_type": ["origin_country", "type"],
    "headline_saving": ["savings_percent"],
    "flight_top5": ["origin_city", "destination_city", "passengers_2019"],
    "impact_by_type": ["type"],
    "impact_top10": ["origin", "destination", "co2_savings_kg"],
    "quality_night": ["total"],
    "quality_day": ["total"],
    "flight_routes_sample": ["origin_city", "destination_city", "passengers_2019"],
}

TABLES = ("stops", "trips", "routes", "stop_times")
INPUTS = (*TABLES, "feeds", "mode_sheet", "flight_sheet")


@dataclass
class PipelineResult:
    outputs: dict[str, DataFrame] = field(default_factory=dict)
    step_rows: dict[str, int] = field(default_factory=dict)
    manifest: DataFrame | None = None
    skipped_feeds: list[dict] = field(default_factory=list)  # feeds left out, with the reason
    reused: list[str] = field(default_factory=list)  # datasets on record, not written anew


def run_pipeline(
    spark: SparkSession,
    tables: GtfsTables,
    out_dir: str,
    mode_sheet: DataFrame | None = None,
    flight_sheet: DataFrame | None = None,
    night_map=None,
    day_map=None,
    calculation_date: dt.date | None = None,
    flight_sample: int = 50,
    fmt: str = "parquet",
    known: Mapping[str, str] | None = None,
) -> PipelineResult:
    """``known`` gives fingerprints of inputs (``INPUTS``) that the caller has at less than a scan,
    e.g. ``listing_fingerprint`` of the feeds' folders for the four tables."""
    out_dir = out_dir.rstrip("/")
    res = PipelineResult()
    if "skip_reason" in tables.feeds.columns:  # one row per feed
        skipped = tables.feeds.where("skip_reason IS NOT NULL").select("feed_id", "skip_reason").collect()
        res.skipped_feeds = [r.asDict() for r in skipped]

    frames = {name: getattr(tables, name) for name in (*TABLES, "feeds")} | {"mode_sheet": mode_sheet, "flight_sheet": flight_sheet}
    known = dict(known or {})
    scanned = {name: df for name, df in frames.items() if df is not None and name not in known}
    run = StagedRun(spark, out_dir, fmt, known | fingerprints(scanned))
    feeds = [*TABLES, "feeds"]

    def stage(name: str, build: Callable[[], DataFrame], reads, given=(), partition_by=None) -> DataFrame:
        return run.stage(name, build, [reads] if isinstance(reads, str) else reads, given, partition_by)

    # 1. extraction (OPS1-OPS3)
    # both kinds in one chain, written by kind; the two outputs are its folders' rows
    extracted = stage("extracted_routes", lambda: X.extract_routes(tables, None, {"night": night_map, "day": day_map}),
                      feeds, [list(tables.scope), repr(night_map), repr(day_map)], partition_by=["service_type"])
    night = stage("night_routes", lambda: extracted.where("service_type = 'night'"), "extracted_routes")
    day = stage("day_routes", lambda: extracted.where("service_type = 'day'"), "extracted_routes")
    stage("night_by_country", lambda: X.routes_by_origin_country(night), "night_routes")
    stage("day_by_country", lambda: X.routes_by_origin_country(day), "day_routes")
    stage("unresolved_day", lambda: X.unresolved_countries(day), "day_routes")

    # 2. emission reference, summary, flights (OPS8-OPS11)
    reference = None
    if mode_sheet is not None:
        reference = stage("emissions_reference", lambda: E.emission_reference(mode_sheet), "mode_sheet")
        stage("emissions_summary", lambda: E.emission_summary(reference), "emissions_reference")
        stage("headline_saving", lambda: E.headline_saving(reference), "emissions_reference")
    if flight_sheet is not None:
        flights = E.flight_routes(flight_sheet, flight_sample)
        stage("flight_routes_sample", lambda: flights.drop("ord"), "flight_sheet", [flight_sample])
        stage("flight_top5", lambda: E.top_flights(flights, 5), "flight_sheet", [flight_sample])

    # 3. cleaning, exclusion, quality, combination (OPS4-OPS7)
    night_clean = stage("night_routes_cleaned", lambda: C.clean_night(night), "night_routes")
    day_clean = stage("day_routes_cleaned", lambda: C.clean_routes(day, "day"), "day_routes")
    stage("quality_night", lambda: C.quality_report(night_clean), "night_routes_cleaned")
    stage("quality_day", lambda: C.quality_report(day_clean), "day_routes_cleaned")
    combined = stage("all_routes_cleaned", lambda: C.combine_types(night_clean, day_clean),
                     ["night_routes_cleaned", "day_routes_cleaned"], partition_by=["type"])
    stage("routes_by_country", lambda: X.routes_by_origin_country(combined), "all_routes_cleaned")
    stage("routes_by_type", lambda: C.routes_by_type(combined), "all_routes_cleaned")
    stage("routes_by_country_type", lambda: C.routes_by_country_type(combined), "all_routes_cleaned")

    # 4. impact and summaries (OPS12-OPS14)
    if calculation_date is None:
        calculation_date = spark.range(1).select(F.current_date().alias("d")).first()["d"]
    factors_of = ["emissions_reference"] if reference is not None else []
    impact = stage(
        "environmental_impact",
        lambda: I.environmental_impact(combined, E.emission_factors(reference, spark), calculation_date),
        ["all_routes_cleaned", *factors_of], [calculation_date.isoformat()],
    )
    stage("impact_totals", lambda: I.impact_totals(impact), "environmental_impact")
    by_country = stage("impact_by_country", lambda: I.impact_by_country(impact), "environmental_impact")
    stage("impact_by_country_top10", lambda: I.top_countries(by_country, 10), "impact_by_country")
    stage("impact_by_type", lambda: I.impact_by_type(impact), "environmental_impact")
    stage("impact_top10", lambda: I.top_routes(impact, 10), "environmental_impact")

    # 5. publish, manifest (OPS16)
    res.outputs, res.step_rows, res.reused = run.publish(), run.rows, run.reused
    res.manifest = output_manifest(spark, out_dir, {k: v for k, v in OUTPUT_KEYS.items() if k in res.outputs}, fmt)
    return res
