"""Command line: the whole run over all feeds.

    spark-submit -m railtrace run --registry feeds.csv --out /shared/out \\
        [--modes modes.csv] [--flights flights.csv] [--date 2024-01-01]

``feeds.csv`` has the columns ``feed_id,path,kind,country`` (``kind`` is
``night`` or ``day``; ``country`` may be empty).  Outputs are written as
Parquet under ``--out`` (a shared folder on a cluster), where the last whole run's
stay until this one is whole; stages whose input has not changed are not run again.
The manifest and the impact summaries are printed.  ``--local N`` starts a local session instead
of using the one spark-submit provides.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="railtrace")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="extract, clean and compute emissions for all feeds")
    run.add_argument("--registry", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--modes")
    run.add_argument("--flights")
    run.add_argument("--date", type=dt.date.fromisoformat)
    run.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    run.add_argument("--local", type=int, default=0)
    inv = sub.add_parser("inventory", help="which feeds are usable")
    inv.add_argument("--registry", required=True)
    inv.add_argument("--root", required=True)
    inv.add_argument("--local", type=int, default=0)
    args = ap.parse_args(argv)

    if args.local:
        from railtrace.session import local_session

        spark = local_session(args.local)
    else:
        spark = SparkSession.builder.appName("railtrace").getOrCreate()

    from railtrace.sources.gtfs import feed_inventory, feed_registry, read_feeds

    # read by Spark, so it may lie in any store; one row per feed
    rows = spark.read.option("header", True).csv(args.registry).collect()
    feeds = [(r["feed_id"], r["path"], r["kind"], r.asDict().get("country") or None) for r in rows]
    registry = feed_registry(spark, feeds)

    if args.cmd == "inventory":
        feed_inventory(spark, registry, args.root, count_rows=True).show(truncate=False)
        return

    from railtrace.plans.pipeline import TABLES, run_pipeline
    from railtrace.sinks.publish import listing_fingerprint
    from railtrace.sources.sheets import flight_sheet, mode_sheet

    files = listing_fingerprint(spark, sorted({f[1] for f in feeds}))  # the feeds' text is read once
    res = run_pipeline(
        spark,
        read_feeds(spark, registry),
        args.out,
        mode_sheet(spark, args.modes) if args.modes else None,
        flight_sheet(spark, args.flights) if args.flights else None,
        calculation_date=args.date,
        fmt=args.format,
        known=dict.fromkeys(TABLES, files),
    )
    for feed in res.skipped_feeds:
        print(f"skipped {feed['feed_id']}: {feed['skip_reason']}")
    for step, rows in res.step_rows.items():
        print(f"{step:28s} {rows:>12,d} rows{' (as before)' if step in res.reused else ''}")
    res.manifest.show(truncate=False)
    for name in ("impact_totals", "impact_by_country_top10", "impact_by_type", "impact_top10", "headline_saving"):
        if name in res.outputs:
            res.outputs[name].show(truncate=False)


if __name__ == "__main__":
    main()
