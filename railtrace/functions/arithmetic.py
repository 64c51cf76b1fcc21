"""Emission arithmetic (SCL10-SCL17) with exact decimal rounding.

Distances are DECIMAL(12,2) and factors DECIMAL(12,6), so kilograms come from
exact decimal products; every rounding is HALF_UP on the exact value, which
makes results independent of the engine that computes them (SURVEY D5).
Ratios are computed in integers (``ratio_half_up``) because decimal division
is engine-specific.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from railtrace.schemas import FACTOR, KG


def _milli() -> Column:
    return F.lit(Decimal("0.001"))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def factor(c) -> Column:
    """An emission factor (g CO2 per passenger-km) as DECIMAL(12,6); null
    when it does not fit."""
    return _col(c).try_cast(FACTOR)


def kg_raw(distance_km, gco2_per_pkm) -> Column:
    """SCL10 before rounding: distance x factor / 1000, exact."""
    return _col(distance_km) * _col(gco2_per_pkm) * _milli()


def round_kg(c) -> Column:
    """SCL13: kilograms to 2 decimals (HALF_UP)."""
    return _col(c).cast(KG)


def kg_to_tons(c) -> Column:
    """SCL17: kilograms -> tons, 2 decimals."""
    return (_col(c) * _milli()).cast(KG)


def _floor_div(a: Column, b: Column) -> Column:
    """Exact floor(a / b) for non-negative integral a and positive b."""
    return ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")


def ratio_half_up(num, den, digits: int, scale: int = 6) -> Column:
    """``round(num / den, digits)`` HALF_UP (away from zero), exact.

    ``num`` and ``den`` hold at most ``scale`` decimals.  null when ``den`` is
    0 or null (SURVEY D6: never NaN).
    """
    n = (_col(num) * F.lit(10 ** scale)).cast("decimal(38,0)")
    d = (_col(den) * F.lit(10 ** scale)).cast("decimal(38,0)")
    q = _floor_div(F.abs(n) * F.lit(2 * 10 ** digits) + F.abs(d), F.abs(d) * F.lit(2))
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    unit = F.lit(Decimal(1).scaleb(-digits))
    return F.when(d != 0, (signed * unit).cast(f"decimal(20,{digits})"))


def percent_saved(baseline, value, digits: int = 1) -> Column:
    """SCL12/14/15: ``(baseline - value) / baseline * 100`` rounded; null when
    the baseline is 0 or missing."""
    b = factor(baseline)
    return ratio_half_up((b - factor(value)) * F.lit(100), b, digits)
