"""Great-circle distance (SCL3) as a native expression."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from railtrace.functions._memo import memo_column
from railtrace.schemas import DISTANCE

# Fixed value: mean Earth radius used by the reference, in km.
EARTH_RADIUS_KM = 6371.0
_DEG = math.pi / 180.0


def _num(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    d = c.try_cast("double")  # text coordinates from CSV; a no-op for doubles
    # non-finite coordinates give no distance
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def haversine_raw(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km as double; null if any coordinate is null or
    not a number."""
    coords = [_num(x) for x in (lat1, lon1, lat2, lon2)]
    p1, l1, p2, l2 = (c * F.lit(_DEG) for c in coords)
    s_lat = F.sin((p2 - p1) / 2)
    s_lon = F.sin((l2 - l1) / 2)
    a = s_lat * s_lat + F.cos(p1) * F.cos(p2) * s_lon * s_lon
    # rounding can push a a hair above 1 for antipodal points; least() would
    # turn a null into 1, so nulls are guarded on the (small) coordinates
    dist = F.lit(2.0) * F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * F.lit(EARTH_RADIUS_KM)
    known = coords[0].isNotNull() & coords[1].isNotNull() & coords[2].isNotNull() & coords[3].isNotNull()
    return F.when(known, dist)


@memo_column
def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """SCL3: distance rounded to 2 decimals, as DECIMAL(12,2)."""
    return F.round(haversine_raw(lat1, lon1, lat2, lon2), 2).cast(DISTANCE)
