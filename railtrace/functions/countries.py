"""Station -> country code rules (SCL4 night, SCL5 day) as CASE expressions.

A station map is an *ordered* list of (substring key, country code); the first
key that matches wins.  Because the map is configuration-sized, the rule is
compiled into one ``CASE WHEN`` chain evaluated inside whole-stage codegen, so
it costs no join and no shuffle.  ``operators.countries`` has the equivalent
broadcast theta join for maps held in a DataFrame.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from railtrace.functions._memo import memo_column

# Fixed values (must equal the reference's maps; order is significant).
NIGHT_STATION_COUNTRIES = [
    ("basel", "CH"), ("zurich", "CH"), ("brig", "CH"), ("lausanne", "CH"),
    ("geneve", "CH"), ("geneva", "CH"), ("montreux", "CH"), ("olten", "CH"),
    ("liestal", "CH"), ("como", "IT"), ("chiasso", "IT"), ("lugano", "IT"),
    ("bellinzona", "IT"), ("domodossola", "IT"), ("simplontunnel", "IT"),
    ("paris nord", "FR"), ("paris gare du nord", "FR"), ("lyon", "FR"),
    ("marseille", "FR"), ("nice", "FR"), ("bruxelles midi", "BE"),
    ("brussels midi", "BE"), ("amsterdam centraal", "NL"), ("rotterdam centraal", "NL"),
    ("wien", "AT"), ("vienna", "AT"), ("munchen", "DE"), ("munich", "DE"),
    ("berlin", "DE"), ("hamburg", "DE"), ("koln", "DE"), ("cologne", "DE"),
    ("frankfurt", "DE"), ("salzburg", "AT"), ("innsbruck", "AT"), ("graz", "AT"),
    ("prague", "CZ"), ("budapest", "HU"),
]
DAY_STATION_COUNTRIES = [
    ("st pancras international", "GB"), ("london st pancras", "GB"),
    ("paris nord", "FR"), ("paris gare du nord", "FR"), ("bruxelles midi", "BE"),
    ("brussels midi", "BE"), ("amsterdam centraal", "NL"), ("rotterdam centraal", "NL"),
    ("lille europe", "FR"), ("calais ville", "FR"), ("dunkerque", "FR"),
    ("basel", "CH"), ("zurich", "CH"), ("koln", "DE"), ("cologne", "DE"),
    ("dortmund", "DE"), ("essen", "DE"), ("marne la vallee", "FR"),
    ("bourg st maurice", "FR"),
]
UNKNOWN = "UNKNOWN"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_country(station, mapping: Iterable[tuple[str, str]], both_directions: bool, default=None) -> Column:
    """First code whose key is contained in ``station`` (and, with
    ``both_directions``, also when ``station`` is contained in the key)."""
    s = _col(station)
    expr = None
    for key, code in mapping:
        key = key.lower().strip()
        cond = s.contains(key)
        if both_directions:
            cond = cond | F.lit(key).contains(s)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    default_col = F.lit(default).cast("string")
    return default_col if expr is None else expr.otherwise(default_col)


def has_feed_country(feed_country) -> Column:
    fc = _col(feed_country)
    return fc.isNotNull() & (fc != "")


@memo_column
def night_country(station, feed_country, mapping=NIGHT_STATION_COUNTRIES) -> Column:
    """SCL4: feed country if set; empty station -> UNKNOWN; else first key with
    key in station or station in key; else UNKNOWN."""
    s = _col(station)
    return (
        F.when(has_feed_country(feed_country), _col(feed_country))
        .when(s.isNull() | (s == ""), F.lit(UNKNOWN))
        .otherwise(map_country(s, mapping, both_directions=True, default=UNKNOWN))
    )


@memo_column
def day_country(station, feed_country, mapping=DAY_STATION_COUNTRIES) -> Column:
    """SCL5: feed country if set; else first key contained in the station;
    else null."""
    return F.when(has_feed_country(feed_country), _col(feed_country)).otherwise(
        map_country(F.lower(_col(station)), mapping, both_directions=False)
    )


def country_rule(kind: str):
    return night_country if kind == "night" else day_country


def default_station_map(kind: str):
    return NIGHT_STATION_COUNTRIES if kind == "night" else DAY_STATION_COUNTRIES
