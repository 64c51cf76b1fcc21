"""Column -> Column scalar rules.  All native Spark expressions."""

from railtrace.functions.arithmetic import (  # noqa: F401
    factor, kg_raw, kg_to_tons, percent_saved, ratio_half_up, round_kg,
)
from railtrace.functions.countries import (  # noqa: F401
    DAY_STATION_COUNTRIES, NIGHT_STATION_COUNTRIES, UNKNOWN, day_country,
    map_country, night_country,
)
from railtrace.functions.geo import haversine_km, haversine_raw  # noqa: F401
from railtrace.functions.text import (  # noqa: F401
    is_blank, normalize_text, py_strip, route_label, simplify_station,
    strip_stars, title_case_station, to_number,
)
