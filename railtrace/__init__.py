"""railtrace: rail route and emissions analytics on Spark.

Reads many GTFS feeds at once, derives one row per origin-destination rail
route with a great-circle distance, cleans and de-duplicates day and night
routes, and compares train with plane emissions.  Every step is a DataFrame
transformation: no function here starts a session, collects rows, or runs
per-row Python.

Layout:
    functions/  Column -> Column scalar rules (text, geo, arithmetic)
    sources/    readers (GTFS feeds, sheets, route tables, feed inventory)
    sinks/      writers and the output manifest
    operators/  DataFrame -> DataFrame building blocks and composites
    plans/      the end-to-end pipeline and the driver-table query set
"""

__version__ = "0.1.0"
