"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark code: views, text rules, Haversine,
de-duplication and decimal arithmetic are restated in SQL.  Shared steps are
named CTEs; each query string carries exactly the CTEs it references.
Ascending sorts say NULLS FIRST and descending NULLS LAST explicitly, which
is Spark's default and not DuckDB's.
"""

from __future__ import annotations

import re
from decimal import Decimal

from railtrace.functions.countries import UNKNOWN
from railtrace.functions.text import ROUTE_ARROW, SIMPLIFY_REMOVED_WORDS, SIMPLIFY_SMALL_WORDS
from railtrace.plans import driver_views as V
from railtrace.plans.pipeline import OUTPUT_KEYS
from railtrace.plans.queries import AUDITED_TABLES, CALCULATION_DATE, FLIGHT_SAMPLE, LACKING_MODES


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


ARROW = q(ROUTE_ARROW)


# --- scalar rules ---------------------------------------------------------

def norm(x: str) -> str:
    """SCL1 on text whose non-ASCII letters all have canonical decompositions."""
    s = f"strip_accents(lower({x}))"
    s = rf"regexp_replace({s}, '[^\x00-\x7F]', '', 'g')"
    s = f"regexp_replace({s}, '[^a-z0-9 ]', ' ', 'g')"
    return f"coalesce(trim(regexp_replace({s}, ' +', ' ', 'g')), '')"


def simplify(x: str) -> str:
    s = rf"lower(regexp_replace({x}, '^\s+|\s+$', '', 'g'))"
    s = rf"regexp_replace({s}, '\b({'|'.join(SIMPLIFY_REMOVED_WORDS)})\b', '', 'g')"
    s = rf"trim(regexp_replace({s}, '\s+', ' ', 'g'))"
    small = ", ".join(q(w) for w in SIMPLIFY_SMALL_WORDS)
    word = f"CASE WHEN w IN ({small}) THEN w ELSE upper(left(w, 1)) || lower(substr(w, 2)) END"
    return f"coalesce(array_to_string(list_transform(string_split({s}, ' '), lambda w: {word}), ' '), '')"


def title(x: str) -> str:
    """SCL6 on lower-case ASCII text: upper-case each letter after a non-letter."""
    runs = f"regexp_extract_all(trim({x}), '[a-z]+|[^a-z]+')"
    return f"coalesce(array_to_string(list_transform({runs}, lambda r: upper(left(r, 1)) || substr(r, 2)), ''), '')"


def country(station: str, feed_country: str, night: bool) -> str:
    whens = []
    for key, code in V.DRIVER_STATION_MAP:
        cond = f"contains({station}, {q(key)})"
        if night:
            cond += f" OR contains({q(key)}, {station})"
        whens.append(f"WHEN {cond} THEN {q(code)}")
    head = f"CASE WHEN {feed_country} IS NOT NULL AND {feed_country} <> '' THEN {feed_country} "
    if night:
        head += f"WHEN {station} IS NULL OR {station} = '' THEN {q(UNKNOWN)} "
        return head + " ".join(whens) + f" ELSE {q(UNKNOWN)} END"
    return head + " ".join(whens).replace(f"{station}", f"lower({station})") + " ELSE NULL END"


def haversine(lat1, lon1, lat2, lon2) -> str:
    r = "(pi() / 180.0)"
    p1, l1, p2, l2 = (f"({c} * {r})" for c in (lat1, lon1, lat2, lon2))
    a = (f"(sin(({p2} - {p1}) / 2) * sin(({p2} - {p1}) / 2) + "
         f"cos({p1}) * cos({p2}) * sin(({l2} - {l1}) / 2) * sin(({l2} - {l1}) / 2))")
    known = " AND ".join(f"{c} IS NOT NULL" for c in (lat1, lon1, lat2, lon2))
    dist = f"round(2.0 * asin(sqrt(CASE WHEN {a} > 1.0 THEN 1.0 ELSE {a} END)) * 6371.0, 2)"
    return f"CAST(CASE WHEN {known} THEN {dist} END AS DECIMAL(12,2))"


def ratio(num: str, den: str, digits: int, scale: int = 6) -> str:
    """round(num / den, digits) HALF_UP in integers; NULL when den = 0."""
    n = f"CAST(({num}) * {10 ** scale} AS HUGEINT)"
    d = f"CAST(({den}) * {10 ** scale} AS HUGEINT)"
    qq = f"((abs({n}) * {2 * 10 ** digits} + abs({d})) // (2 * abs({d})))"
    signed = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -{qq} ELSE {qq} END)"
    unit = Decimal(1).scaleb(-digits)
    return f"(CASE WHEN {d} <> 0 THEN CAST(CAST({signed} AS DECIMAL(20,0)) * {unit} AS DECIMAL(20,{digits})) END)"


def factor(x: str) -> str:
    return f"TRY_CAST({x} AS DECIMAL(12,6))"


def pct_saved(baseline: str, value: str) -> str:
    return ratio(f"({factor(baseline)} - {factor(value)}) * 100", factor(baseline), 1)


def first_by(expr_order: str, partition: str, order: str) -> str:
    return f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {partition} ORDER BY {order}) AS rn FROM {expr_order}) WHERE rn = 1"


# --- views ------------------------------------------------------------------

def _feeds_values(fallback: bool) -> str:
    rows = []
    for kind, countries in (("night", V.NIGHT_FEED_COUNTRIES), ("day", V.DAY_FEED_COUNTRIES)):
        for i, (prio, c) in enumerate(zip(V.PRIORITIES, countries)):
            fid = f"{kind}/{prio}"
            has_st = "false" if (fallback and fid == V.FALLBACK_FEED) else "true"
            rows.append(f"({q(fid)}, {q(kind)}, {q(c) if c else 'NULL'}, {i}, {has_st})")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") t(feed_id, kind, country, ord, has_stop_times)"


def _mode_label() -> str:
    item = "split_part(p_name, ' ', 2)"
    adj = "split_part(p_name, ' ', 1)"
    mode = "CASE " + " ".join(f"WHEN {item} = {q(w)} THEN {q(m)}" for w, m in V.MODE_OF_ITEM)
    mode += f" ELSE upper(left({item}, 1)) || substr({item}, 2) END"
    return (
        f"CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN ' * ' "
        f"WHEN {adj} = 'new' THEN ({mode}) || '*' WHEN {adj} = 'cold' THEN lower({mode}) "
        f"ELSE upper(left({adj}, 1)) || substr({adj}, 2) || ' ' || ({mode}) || ' **' END"
    )


CTES: list[tuple[str, str]] = [
    ("feeds", _feeds_values(False)),
    ("feeds_fb", _feeds_values(True)),
    ("stops", """SELECT CAST(p_partkey AS VARCHAR) AS stop_id, p_name AS stop_name,
        CASE WHEN p_size <> 50 THEN CAST((p_partkey * 7919) % 2500 AS DOUBLE) / 100.0 + 35.0 END AS stop_lat,
        CAST((p_partkey * 104729) % 4000 AS DOUBLE) / 100.0 - 10.0 AS stop_lon FROM part"""),
    ("stop_times", """SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(l_partkey AS VARCHAR) AS stop_id,
        l_linenumber AS stop_sequence FROM lineitem"""),
    ("trips", """SELECT (CASE WHEN o_orderstatus = 'F' THEN 'night' ELSE 'day' END) || '/' || o_orderpriority AS feed_id,
        CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey AS VARCHAR) AS route_id,
        CAST(o_custkey AS VARCHAR) AS start_stop_id, CAST(o_custkey + 1 AS VARCHAR) AS end_stop_id FROM orders"""),
    ("routes", """SELECT CAST(c_custkey AS VARCHAR) AS route_id,
        CASE WHEN c_nationkey = 0 THEN NULL WHEN c_nationkey = 1 THEN '  '
             WHEN c_nationkey = 2 THEN ' red plate ' ELSE c_mktsegment END AS route_short_name FROM customer"""),
    ("ends", """SELECT trip_id,
        first(stop_id ORDER BY stop_sequence ASC NULLS FIRST, stop_id ASC NULLS FIRST) AS first_stop_id,
        first(stop_id ORDER BY stop_sequence DESC NULLS LAST, stop_id DESC NULLS LAST) AS last_stop_id
        FROM stop_times GROUP BY trip_id"""),
    ("so", f"""SELECT stop_id AS first_stop_id, stop_name AS origin_name, stop_lat AS origin_lat,
        stop_lon AS origin_lon, {norm('stop_name')} AS origin FROM stops
        WHERE stop_name IS NOT NULL AND trim(stop_name) <> ''"""),
    ("sd", f"""SELECT stop_id AS last_stop_id, stop_name AS destination_name, stop_lat AS dest_lat,
        stop_lon AS dest_lon, {norm('stop_name')} AS destination FROM stops
        WHERE stop_name IS NOT NULL AND trim(stop_name) <> ''"""),
]


# Lines of the feeds' files (plans/feed_views.py), counted from the tables.
_LACKING = "('night/3-MEDIUM', 'day/4-NOT SPECIFIED', 'day/5-LOW')"
CTES.append(("feed_lines", """
    SELECT feed_id, 'stops' AS tab, 'accepted' AS reason, (SELECT count(*) FROM part) AS records FROM feeds
    UNION ALL SELECT feed_id, 'routes', 'accepted', (SELECT count(*) FROM customer) FROM feeds
    UNION ALL SELECT feed_id, 'trips', 'accepted', count(*) FROM trips GROUP BY feed_id
    UNION ALL SELECT feed_id, 'stop_times', reason, sum(n)::BIGINT FROM (
        SELECT t.feed_id, unnest([
            {'reason': 'accepted', 'n': 1}, {'reason': 'too many fields', 'n': CASE WHEN s.stop_id::BIGINT % 97 = 0 THEN 1 ELSE 0 END},
            {'reason': 'too few fields', 'n': CASE WHEN s.stop_id::BIGINT % 89 = 0 THEN 1 ELSE 0 END},
            {'reason': 'open quote', 'n': CASE WHEN s.stop_id::BIGINT % 83 = 0 THEN 2 ELSE 0 END}], recursive := true)
        FROM stop_times s JOIN trips t USING (trip_id)) GROUP BY feed_id, reason"""))


def _extract_ctes(kind: str, feeds: str = "feeds", suffix: str = "") -> list[tuple[str, str]]:
    k = kind + suffix
    night = kind == "night"
    if night:
        first, last = "e.first_stop_id", "e.last_stop_id"
        gate = "AND f.has_stop_times"
    else:
        first = "CASE WHEN f.has_stop_times THEN e.first_stop_id ELSE t.start_stop_id END"
        last = "CASE WHEN f.has_stop_times THEN e.last_stop_id ELSE t.end_stop_id END"
        gate = ""
    rn = f"""CASE WHEN r.route_short_name IS NULL OR trim(r.route_short_name) = ''
                   OR trim(r.route_short_name) = trim(so.origin_name)
              THEN so.origin_name || {ARROW} || sd.destination_name ELSE r.route_short_name END"""
    return [
        (f"tsi_{k}", f"""SELECT * FROM (SELECT t.feed_id, t.trip_id, f.country AS feed_country, f.ord AS feed_ord,
            t.route_id, {first} AS first_stop_id, {last} AS last_stop_id
            FROM trips t JOIN {feeds} f ON t.feed_id = f.feed_id AND f.kind = {q(kind)} {gate}
            LEFT JOIN ends e ON t.trip_id = e.trip_id)
            WHERE first_stop_id IS NOT NULL AND last_stop_id IS NOT NULL"""),
        (f"att_{k}", f"""SELECT p.*, r.route_short_name, so.origin_name, so.origin_lat, so.origin_lon, so.origin,
            sd.destination_name, sd.dest_lat, sd.dest_lon, sd.destination, {rn} AS route_name
            FROM (SELECT DISTINCT feed_id, feed_country, feed_ord, route_id, first_stop_id, last_stop_id FROM tsi_{k}) p
            LEFT JOIN routes r ON p.route_id = r.route_id
            JOIN so ON p.first_stop_id = so.first_stop_id
            JOIN sd ON p.last_stop_id = sd.last_stop_id"""),
        (f"dist_{k}", f"""SELECT * FROM (SELECT *, {haversine('origin_lat', 'origin_lon', 'dest_lat', 'dest_lon')} AS distance_km
            FROM att_{k}) WHERE distance_km IS NOT NULL"""),
        (f"ded1_{k}", first_by(
            f"dist_{k}", "feed_id, least(origin, destination), greatest(origin, destination)",
            "origin NULLS FIRST, destination NULLS FIRST, route_name NULLS FIRST, distance_km NULLS FIRST, "
            "origin_name NULLS FIRST, destination_name NULLS FIRST")),
        (f"fr_{k}", f"""SELECT feed_id, feed_ord, route_name, origin, destination, {q(kind)} AS service_type,
            {simplify('origin')} || {ARROW} || {simplify('destination')} AS route_name_simple,
            {country('origin', 'feed_country', night)} AS origin_country,
            {country('destination', 'feed_country', night)} AS destination_country,
            distance_km FROM ded1_{k}"""),
        (f"win_{k}", first_by(
            f"fr_{k}", "origin, destination, route_name",
            "feed_ord NULLS FIRST, feed_id NULLS FIRST, distance_km NULLS FIRST, route_name_simple NULLS FIRST, "
            "origin_country NULLS FIRST, destination_country NULLS FIRST")),
        (f"ext_{k}", f"""SELECT route_name, origin, destination, service_type, route_name_simple, origin_country,
            destination_country, distance_km FROM ({first_by(
                f"fr_{k}", "origin, destination, route_name",
                "feed_ord NULLS FIRST, feed_id NULLS FIRST, distance_km NULLS FIRST, route_name_simple NULLS FIRST, "
                "origin_country NULLS FIRST, destination_country NULLS FIRST")})"""),
    ]


def _clean_cte(kind: str) -> tuple[str, str]:
    titled = f"""SELECT route_name, {title('trim(origin)')} AS origin, {title('trim(destination)')} AS destination,
        service_type, route_name_simple, origin_country, destination_country, distance_km FROM ext_{kind}"""
    filled = f"""SELECT route_name, origin, destination, service_type,
        CASE WHEN route_name_simple IS NULL OR trim(route_name_simple) = '' THEN origin || {ARROW} || destination
             ELSE route_name_simple END AS route_name_simple, origin_country, destination_country, distance_km,
        CASE WHEN origin < destination THEN origin || '_' || destination ELSE destination || '_' || origin END AS pair
        FROM ({titled})"""
    kept = first_by(
        f"({filled})", "pair",
        "origin NULLS FIRST, destination NULLS FIRST, route_name NULLS FIRST, distance_km NULLS FIRST, "
        "route_name_simple NULLS FIRST, service_type NULLS FIRST, origin_country NULLS FIRST, destination_country NULLS FIRST")
    body = f"""SELECT route_name, origin, destination, service_type, route_name_simple, origin_country,
        destination_country, distance_km, {q(kind)} AS type FROM ({kept})"""
    if kind == "night":
        body = f"""SELECT * FROM ({body}) WHERE origin_country IS NOT NULL AND destination_country IS NOT NULL
            AND origin_country <> {q(UNKNOWN)} AND destination_country <> {q(UNKNOWN)}"""
    return (f"cl_{kind}", body)


CTES += _extract_ctes("night") + _extract_ctes("day") + _extract_ctes("day", "feeds_fb", "_fb")
CTES += [_clean_cte("night"), _clean_cte("day")]
CTES += [("ext_raw", """SELECT route_name, CASE WHEN origin LIKE 'red%' THEN NULL ELSE origin END AS origin,
    CASE WHEN destination LIKE 'hot%' THEN '  ' ELSE destination END AS destination,
    CASE WHEN distance_km < 100 THEN NULL ELSE service_type END AS service_type,
    CASE WHEN origin LIKE 'old%' THEN NULL WHEN origin LIKE 'new%' THEN ' ' ELSE route_name_simple END AS route_name_simple,
    origin_country, destination_country, distance_km FROM ext_day"""), _clean_cte("raw")]
CTES += [
    ("combined", f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY origin, destination, route_name
        ORDER BY CASE WHEN type = 'night' THEN 0 ELSE 1 END, distance_km NULLS FIRST, route_name_simple NULLS FIRST,
        service_type NULLS FIRST, origin_country NULLS FIRST, destination_country NULLS FIRST) AS rn
        FROM (SELECT * FROM cl_night UNION ALL SELECT * FROM cl_day)) WHERE rn = 1"""),
    ("modes", f"""SELECT p_partkey AS ord, {_mode_label()} AS c0,
        CASE WHEN p_size IN (3, 4, 5) THEN NULL WHEN p_size = 6 THEN CAST(1000 AS DOUBLE) ELSE p_retailprice END AS g,
        CASE WHEN p_size = 7 THEN NULL ELSE p_retailprice * 3 END AS g3 FROM part"""),
    ("reference", f"""SELECT ord, trim(replace(c0, '*', '')) AS transport_mode, g AS gco2_per_pkm,
        g3 AS gco2_per_pkm_rf3, 'Back-on-Track' AS source, CAST(2019 AS INTEGER) AS year
        FROM modes WHERE c0 IS NOT NULL"""),
    ("baselines", """SELECT
        nullif(arg_min_null(gco2_per_pkm, ord) FILTER (WHERE contains(transport_mode, 'Plane')), 0) AS plane,
        nullif(arg_min_null(gco2_per_pkm, ord) FILTER (WHERE contains(transport_mode, 'Car')), 0) AS car
        FROM reference"""),
    ("factors", """SELECT
        TRY_CAST(CASE WHEN count(*) FILTER (WHERE contains(lower(transport_mode), 'night train')) = 0 THEN 14
             ELSE arg_min_null(gco2_per_pkm, ord) FILTER (WHERE contains(lower(transport_mode), 'night train')) END
             AS DECIMAL(12,6)) AS train_gco2_pkm,
        TRY_CAST(CASE WHEN count(*) FILTER (WHERE transport_mode = 'Plane') = 0 THEN 144
             ELSE arg_min_null(gco2_per_pkm, ord) FILTER (WHERE transport_mode = 'Plane') END
             AS DECIMAL(12,6)) AS plane_gco2_pkm,
        TRY_CAST(CASE WHEN count(*) FILTER (WHERE contains(lower(transport_mode), 'car')) = 0 THEN 132
             ELSE arg_min_null(gco2_per_pkm, ord) FILTER (WHERE contains(lower(transport_mode), 'car')) END
             AS DECIMAL(12,6)) AS car_gco2_pkm
        FROM reference"""),
    ("flights", """SELECT * FROM (SELECT o.o_orderkey AS ord, n1.n_name AS origin_city,
        CASE WHEN c.c_acctbal >= 0 THEN n2.n_name END AS destination_city,
        CAST(o.o_custkey AS DOUBLE) AS passengers_2019, o.o_totalprice / 100 AS distance_km,
        CASE WHEN c.c_acctbal > 0 THEN c.c_acctbal / 1000 END AS train_time_hours,
        o.o_totalprice AS aviation_emissions_tco2e, o.o_totalprice / 8 AS train_emissions_tco2e,
        o.o_totalprice - o.o_totalprice / 8 AS co2_savings_tco2e
        FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN nation n1 ON c.c_nationkey = n1.n_nationkey
        LEFT JOIN nation n2 ON (c.c_nationkey + o.o_orderkey) % 25 = n2.n_nationkey)
        WHERE origin_city IS NOT NULL AND destination_city IS NOT NULL"""),
    ("flight_sample_t", f"SELECT * FROM flights ORDER BY ord LIMIT {FLIGHT_SAMPLE}"),
    ("impact", f"""SELECT c.*,
        (SELECT train_gco2_pkm FROM factors) AS train_gco2_pkm,
        (SELECT plane_gco2_pkm FROM factors) AS plane_gco2_pkm,
        CAST(c.distance_km * (SELECT train_gco2_pkm FROM factors) * 0.001 AS DECIMAL(18,2)) AS train_co2_kg,
        CAST(c.distance_km * (SELECT plane_gco2_pkm FROM factors) * 0.001 AS DECIMAL(18,2)) AS plane_co2_kg,
        CAST(c.distance_km * (SELECT plane_gco2_pkm FROM factors) * 0.001
             - c.distance_km * (SELECT train_gco2_pkm FROM factors) * 0.001 AS DECIMAL(18,2)) AS co2_savings_kg,
        CASE WHEN c.distance_km <> 0 THEN {ratio(
            '((SELECT plane_gco2_pkm FROM factors) - (SELECT train_gco2_pkm FROM factors)) * 100',
            '(SELECT plane_gco2_pkm FROM factors)', 1)} END AS savings_percent,
        'Back-on-Track 2019' AS emission_source, DATE '{CALCULATION_DATE.isoformat()}' AS calculation_date
        FROM combined c"""),
]

ROUTE_COLS = ("route_name, origin, destination, service_type, route_name_simple, origin_country, "
              "destination_country, distance_km")

FINAL = {
    "trip_endpoints": "SELECT trip_id, first_stop_id, last_stop_id FROM ends",
    "trip_routes": f"""SELECT p.feed_id, p.trip_id,
        CASE WHEN r.route_short_name IS NULL OR trim(r.route_short_name) = ''
             OR trim(r.route_short_name) = trim(so.origin_name)
             THEN so.origin_name || {ARROW} || sd.destination_name ELSE r.route_short_name END AS route_name,
        so.origin_name, sd.destination_name
        FROM tsi_night p LEFT JOIN routes r ON p.route_id = r.route_id
        JOIN so ON p.first_stop_id = so.first_stop_id JOIN sd ON p.last_stop_id = sd.last_stop_id""",
    "endpoint_fallback": "SELECT feed_id, trip_id, first_stop_id, last_stop_id FROM tsi_day_fb",
    "route_distance": f"""SELECT * FROM (SELECT p.first_stop_id, p.last_stop_id,
        {haversine('so.origin_lat', 'so.origin_lon', 'sd.dest_lat', 'sd.dest_lon')} AS distance_km
        FROM (SELECT DISTINCT first_stop_id, last_stop_id FROM ends) p
        JOIN so ON p.first_stop_id = so.first_stop_id JOIN sd ON p.last_stop_id = sd.last_stop_id)
        WHERE distance_km IS NOT NULL""",
    "normalize_names": f"SELECT doc_id, {norm('text')} AS normalized FROM documents",
    "simplify_names": f"SELECT doc_id, {simplify(norm('text'))} AS simplified FROM documents",
    "title_names": f"SELECT doc_id, {title(norm('text'))} AS titled FROM documents",
    "country_night": f"""SELECT station, {country('station', 'CAST(NULL AS VARCHAR)', True)} AS country
        FROM (SELECT DISTINCT {norm('stop_name')} AS station FROM stops WHERE stop_name IS NOT NULL AND trim(stop_name) <> '')""",
    "country_day": f"""SELECT station, {country('station', 'CAST(NULL AS VARCHAR)', False)} AS country
        FROM (SELECT DISTINCT {norm('stop_name')} AS station FROM stops WHERE stop_name IS NOT NULL AND trim(stop_name) <> '')""",
    "dedupe_pairs_feed": "SELECT * FROM fr_night",
    "extract_night": "SELECT * FROM ext_night",
    "extract_day": "SELECT * FROM ext_day",
    "extract_night_files": "SELECT * FROM ext_night",
    "extract_day_files": "SELECT * FROM ext_day",
    "feed_quarantine": "SELECT feed_id, tab, reason, records FROM feed_lines WHERE records > 0",
    "feed_inventory": f"""SELECT kind, feed_id, CASE GROUPING(kind, feed_id) WHEN 0 THEN 'feed' WHEN 1 THEN 'kind' ELSE 'all' END AS level,
        count(*) AS feeds, count(*) FILTER (reason IS NULL) AS valid, count(*) FILTER (reason IS NOT NULL) AS invalid,
        CAST(sum(tables) AS BIGINT) AS tables, count(*) FILTER (reason LIKE 'missing files%') AS with_missing,
        CAST(sum(records) AS BIGINT) AS records, CASE WHEN GROUPING(kind, feed_id) = 0 THEN max(reason) END AS reason
        FROM (SELECT f.kind, f.feed_id, f.feed_id IN {_LACKING} AS lacking, CASE WHEN lacking THEN 3 ELSE 4 END AS tables,
                     sum(records) FILTER (tab <> 'stop_times' OR f.feed_id NOT IN {_LACKING}) AS records,
                     CASE WHEN lacking AND f.kind = 'night' THEN 'missing files: stop_times.txt'
                          WHEN lacking AND f.ord % 2 = 0 THEN 'neither stop_times nor endpoint columns' END AS reason
              FROM feeds f JOIN feed_lines USING (feed_id) GROUP BY f.kind, f.feed_id, f.ord)
        GROUP BY GROUPING SETS ((kind, feed_id), (kind), ())""",
    "feed_ledger": """SELECT f.feed_id, f.kind, coalesce(p, 0) AS patterns, coalesce(p, 0) - coalesce(a, 0) AS flt1, coalesce(a, 0) - coalesce(d, 0) AS flt2,
        coalesce(d, 0) - coalesce(r, 0) AS ded1, coalesce(r, 0) - coalesce(k, 0) AS ded2, coalesce(k, 0) AS kept
        FROM feeds f
        LEFT JOIN (SELECT feed_id, count(*) AS p FROM (
            SELECT DISTINCT feed_id, route_id, first_stop_id, last_stop_id FROM tsi_night
            UNION ALL SELECT DISTINCT feed_id, route_id, first_stop_id, last_stop_id FROM tsi_day) GROUP BY feed_id) USING (feed_id)
        LEFT JOIN (SELECT feed_id, count(*) AS a FROM (SELECT feed_id FROM att_night UNION ALL SELECT feed_id FROM att_day) GROUP BY feed_id) USING (feed_id)
        LEFT JOIN (SELECT feed_id, count(*) AS d FROM (SELECT feed_id FROM dist_night UNION ALL SELECT feed_id FROM dist_day) GROUP BY feed_id) USING (feed_id)
        LEFT JOIN (SELECT feed_id, count(*) AS r FROM (SELECT feed_id FROM fr_night UNION ALL SELECT feed_id FROM fr_day) GROUP BY feed_id) USING (feed_id)
        LEFT JOIN (SELECT feed_id, count(*) AS k FROM (SELECT feed_id FROM win_night UNION ALL SELECT feed_id FROM win_day) GROUP BY feed_id) USING (feed_id)""",
    "unresolved_day": """SELECT origin, destination, origin_country, destination_country FROM ext_day
        WHERE origin_country IS NULL OR destination_country IS NULL""",
    "clean_night": "SELECT * FROM cl_night",
    "clean_day": "SELECT * FROM cl_day",
    "combined_routes": "SELECT * FROM combined",
    "quality_report": """SELECT count(*) AS total,
        count(*) FILTER (WHERE origin IS NULL) AS null_origin,
        count(*) FILTER (WHERE destination IS NULL) AS null_destination,
        count(*) FILTER (WHERE route_name IS NULL) AS null_route_name,
        count(*) FILTER (WHERE service_type IS NULL) AS null_service_type,
        count(*) FILTER (WHERE trim(origin) = '') AS blank_origin,
        count(*) FILTER (WHERE trim(destination) = '') AS blank_destination,
        count(*) FILTER (WHERE origin_country IS NULL) AS missing_origin_country,
        count(*) FILTER (WHERE destination_country IS NULL) AS missing_destination_country
        FROM cl_day""",
    "quality_raw": """SELECT count(*) AS total,
        count(*) FILTER (WHERE origin IS NULL) AS null_origin,
        count(*) FILTER (WHERE destination IS NULL) AS null_destination,
        count(*) FILTER (WHERE route_name IS NULL) AS null_route_name,
        count(*) FILTER (WHERE service_type IS NULL) AS null_service_type,
        count(*) FILTER (WHERE trim(origin) = '') AS blank_origin,
        count(*) FILTER (WHERE trim(destination) = '') AS blank_destination,
        count(*) FILTER (WHERE origin_country IS NULL) AS missing_origin_country,
        count(*) FILTER (WHERE destination_country IS NULL) AS missing_destination_country
        FROM ext_raw""",
    "clean_raw": "SELECT * FROM cl_raw",
    "preview_day": """SELECT * FROM ext_day ORDER BY route_name NULLS FIRST, origin NULLS FIRST, destination NULLS FIRST, service_type NULLS FIRST,
        route_name_simple NULLS FIRST, origin_country NULLS FIRST, destination_country NULLS FIRST, distance_km NULLS FIRST LIMIT 10""",
    "routes_by_country": """SELECT origin_country, count(*) AS count FROM combined GROUP BY origin_country
        ORDER BY count DESC, origin_country NULLS FIRST""",
    "routes_by_type": "SELECT type, count(*) AS count FROM combined GROUP BY type",
    "routes_by_country_type": """SELECT origin_country, type, count(*) AS count FROM combined
        GROUP BY origin_country, type ORDER BY origin_country NULLS FIRST, type""",
    "emission_reference": "SELECT * FROM reference",
    "emission_summary": f"""SELECT transport_mode, gco2_per_pkm,
        {pct_saved('(SELECT plane FROM baselines)', 'gco2_per_pkm')} AS vs_plane_savings_percent,
        {pct_saved('(SELECT car FROM baselines)', 'gco2_per_pkm')} AS vs_car_savings_percent
        FROM reference WHERE gco2_per_pkm IS NOT NULL AND NOT isnan(gco2_per_pkm)""",
    "flight_sample": """SELECT origin_city, destination_city, passengers_2019, distance_km, train_time_hours,
        aviation_emissions_tco2e, train_emissions_tco2e, co2_savings_tco2e FROM flight_sample_t""",
    "flight_top5": """SELECT origin_city, destination_city, passengers_2019, co2_savings_tco2e FROM flight_sample_t
        WHERE co2_savings_tco2e IS NOT NULL AND NOT isnan(co2_savings_tco2e)
        ORDER BY co2_savings_tco2e DESC, ord LIMIT 5""",
    "emission_factors": "SELECT * FROM factors",
    "headline_saving": f"""SELECT t AS night_train_gco2_pkm, p AS plane_gco2_pkm, {pct_saved('p', 't')} AS savings_percent
        FROM (SELECT
          arg_min_null(gco2_per_pkm, ord) FILTER (WHERE contains(transport_mode, 'Night Train')) AS t,
          arg_min_null(gco2_per_pkm, ord) FILTER (WHERE contains(transport_mode, 'Plane')) AS p,
          count(*) FILTER (WHERE contains(transport_mode, 'Night Train')) AS nt,
          count(*) FILTER (WHERE contains(transport_mode, 'Plane')) AS np
          FROM reference) WHERE nt > 0 AND np > 0""",
    "route_impact": "SELECT * FROM impact",
    "impact_totals": f"""SELECT total_routes, total_train_co2_kg, total_plane_co2_kg, total_co2_savings_kg,
        CAST(total_co2_savings_kg * 0.001 AS DECIMAL(18,2)) AS total_co2_savings_tons,
        {ratio('total_co2_savings_kg', 'total_routes', 2, 2)} AS avg_savings_per_route_kg
        FROM (SELECT count(*) AS total_routes,
          CAST(sum(train_co2_kg) AS DECIMAL(38,2)) AS total_train_co2_kg,
          CAST(sum(plane_co2_kg) AS DECIMAL(38,2)) AS total_plane_co2_kg,
          CAST(sum(co2_savings_kg) AS DECIMAL(38,2)) AS total_co2_savings_kg FROM impact)""",
    "impact_by_country": """SELECT origin_country, count(origin) AS route_count,
        CAST(sum(co2_savings_kg) AS DECIMAL(38,2)) AS co2_savings_kg,
        CAST(CAST(sum(co2_savings_kg) AS DECIMAL(38,2)) * 0.001 AS DECIMAL(18,2)) AS co2_savings_tons
        FROM impact WHERE origin_country IS NOT NULL GROUP BY origin_country""",
    "impact_by_country_top10": """SELECT origin_country, count(origin) AS route_count,
        CAST(sum(co2_savings_kg) AS DECIMAL(38,2)) AS co2_savings_kg,
        CAST(CAST(sum(co2_savings_kg) AS DECIMAL(38,2)) * 0.001 AS DECIMAL(18,2)) AS co2_savings_tons
        FROM impact WHERE origin_country IS NOT NULL GROUP BY origin_country
        ORDER BY co2_savings_kg DESC NULLS LAST, origin_country NULLS FIRST LIMIT 10""",
    "impact_by_type": """SELECT type, count(origin) AS route_count,
        CAST(sum(co2_savings_kg) AS DECIMAL(38,2)) AS co2_savings_kg,
        CAST(CAST(sum(co2_savings_kg) AS DECIMAL(38,2)) * 0.001 AS DECIMAL(18,2)) AS co2_savings_tons
        FROM impact WHERE type IS NOT NULL GROUP BY type""",
    "impact_top10": """SELECT origin, destination, origin_country, destination_country, distance_km, co2_savings_kg
        FROM impact WHERE co2_savings_kg IS NOT NULL
        ORDER BY co2_savings_kg DESC, origin NULLS FIRST, destination NULLS FIRST, route_name NULLS FIRST,
                 type NULLS FIRST LIMIT 10""",
    "output_manifest": " UNION ALL ".join(
        f"""SELECT {q(name)} AS dataset, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows,
            count(*) FILTER (WHERE n > 1) AS duplicate_keys
            FROM (SELECT count(*) AS n FROM {name} GROUP BY {', '.join(keys)})"""
        for name, keys in AUDITED_TABLES.items()
    ),
}


def _needed(sql: str, lookup: dict[str, str]) -> set[str]:
    names = list(lookup)
    need, todo = set(), [sql]
    while todo:
        text = todo.pop()
        for n in names:
            if n not in need and re.search(rf"\b{n}\b", text):
                need.add(n)
                todo.append(lookup[n])
    return need


def build(final: str, **other: str) -> str:
    """``final`` with the CTEs that it needs; ``other`` gives a CTE another body."""
    ctes = dict(CTES) | other
    need = _needed(final, ctes)
    parts = [f"{n} AS ({body})" for n, body in ctes.items() if n in need]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final


for _name in ("extract_night", "extract_day", "endpoint_fallback"):  # other keys, same rows
    FINAL[f"{_name}_scoped"] = FINAL[_name]
FINAL["country_join_night"] = FINAL["country_night"]
FINAL["country_join_day"] = FINAL["country_day"]
FINAL["flight_sample_files"] = FINAL["flight_sample"]
FINAL["first_factors_files"] = """SELECT transport_mode, arg_min_null(gco2_per_pkm, ord) AS gco2_per_pkm, count(*) AS n
    FROM reference GROUP BY transport_mode"""

# the datasets of a run, their rows and their keys
OUTPUTS = {
    "night_routes": FINAL["extract_night"], "day_routes": FINAL["extract_day"],
    "night_by_country": "SELECT DISTINCT origin_country FROM ext_night", "day_by_country": "SELECT DISTINCT origin_country FROM ext_day",
    "unresolved_day": FINAL["unresolved_day"], "emissions_reference": FINAL["emission_reference"],
    "emissions_summary": FINAL["emission_summary"], "headline_saving": FINAL["headline_saving"],
    "flight_routes_sample": FINAL["flight_sample"], "flight_top5": FINAL["flight_top5"],
    "night_routes_cleaned": FINAL["clean_night"], "day_routes_cleaned": FINAL["clean_day"],
    "quality_night": FINAL["quality_report"].replace("cl_day", "cl_night"), "quality_day": FINAL["quality_report"],
    "all_routes_cleaned": FINAL["combined_routes"], "environmental_impact": FINAL["route_impact"],
} | {name: FINAL[name] for name in (
    "routes_by_country", "routes_by_type", "routes_by_country_type", "impact_totals", "impact_by_country",
    "impact_by_country_top10", "impact_by_type", "impact_top10")}
FINAL["published_outputs"] = " UNION ALL ".join(
    f"""SELECT {q(name)} AS dataset, true AS exists, true AS has_bytes, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows,
        count(*) FILTER (WHERE n > 1) AS duplicate_keys
        FROM (SELECT count(*) AS n FROM ({sql}) GROUP BY {', '.join(OUTPUT_KEYS[name])})"""
    for name, sql in OUTPUTS.items()
)

ORACLE_SQL: dict[str, str] = {name: build(sql) for name, sql in FINAL.items()}
_cte = dict(CTES)
ORACLE_SQL["feed_ledger_blank"] = build(FINAL["feed_ledger"], stops=f"""SELECT * REPLACE (
    CASE WHEN CAST(stop_id AS BIGINT) % 11 = 0 THEN NULL WHEN CAST(stop_id AS BIGINT) % 13 = 0 THEN '  ' ELSE stop_name END AS stop_name)
    FROM ({_cte['stops']})""")
_cases = {m: f"SELECT * FROM ({_cte['reference']}) WHERE NOT contains(lower(transport_mode), {q(m)})" for m in LACKING_MODES}
_cases["numbers"] = f"SELECT * REPLACE (CAST(NULL AS DOUBLE) AS gco2_per_pkm) FROM ({_cte['reference']})"
ORACLE_SQL["factor_defaults"] = " UNION ALL ".join(
    f"SELECT *, {q(name)} AS without FROM ({build(FINAL['emission_factors'], reference=body)})" for name, body in _cases.items()
)
