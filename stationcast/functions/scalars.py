"""Scalar column expressions.

All functions return ``Column`` objects built from Spark built-ins, so they
stay inside whole-stage codegen.  Null in -> null out unless stated.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
KELVIN_OFFSET = 273.15
SECONDS_PER_DAY = 86400.0
MAGNUS_A = 17.625
MAGNUS_B = 243.04
EARTH_RADIUS_KM = 6371.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Fixed value: offset of the output quantisation grid (sqrt(2) - 1).
GRID_OFFSET = 0.4142135623730951


def rnd(col, n: int = 6) -> Column:
    """Quantise to 10^-n as round(x * 10^n + c) / 10^n with c = sqrt(2) - 1.

    Used on catalogue outputs that are compared with another engine.  Two
    engines may sum in different orders and differ by an ulp; on a grid
    whose boundaries are decimal ties, a value that is exactly a tie
    (common for means of cent values) would then round differently.  The
    offset moves every boundary off short decimals, while any value with at
    most ``n`` decimals is returned unchanged.  ``standins.r`` is the SQL twin.
    """
    k = float(10 ** n)
    return F.round(_c(col) * F.lit(k) + F.lit(GRID_OFFSET)) / F.lit(k)


# ---------------------------------------------------------------- P4 units
_CONVERSIONS = {
    ("C", "K"): lambda c: c + KELVIN_OFFSET,
    ("K", "C"): lambda c: c - KELVIN_OFFSET,
    ("m", "mm"): lambda c: c * 1000.0,
    ("mm", "m"): lambda c: c / 1000.0,
    # precipitation flux kg m-2 s-1 -> mm/day
    ("kg m-2 s-1", "mm/day"): lambda c: c * SECONDS_PER_DAY,
    # mm/day -> m/s as done for observations
    ("mm/day", "m/s"): lambda c: c / SECONDS_PER_DAY / 1000.0,
    ("m/s", "mm/day"): lambda c: c * SECONDS_PER_DAY * 1000.0,
}


def convert_units(col, frm: str, to: str) -> Column:
    """Explicit unit conversion between the named units."""
    if frm == to:
        return _c(col)
    try:
        return _CONVERSIONS[(frm, to)](_c(col))
    except KeyError:
        raise ValueError(f"no conversion {frm!r} -> {to!r}") from None


# ------------------------------------------------------------ P6-P9 wind/rh
def wind_speed(u, v) -> Column:
    """Wind speed sqrt(u^2 + v^2)."""
    u, v = _c(u), _c(v)
    return F.sqrt(u * u + v * v)


def wind_direction(u, v) -> Column:
    """Meteorological direction (270 - deg(atan2(v, u))) mod 360.

    ``pmod`` keeps the result in [0, 360) for negative angles as Python's
    float ``%`` does.
    """
    return F.pmod(F.lit(270.0) - F.degrees(F.atan2(_c(v), _c(u))), F.lit(360.0))


def relative_humidity(td, t, unit: str = "K", compat: bool = False) -> Column:
    """Relative humidity in % from dewpoint and temperature.

    Magnus ratio 100 * exp(a*td/(b+td)) / exp(a*t/(b+t)).  The constants are
    for Celsius; with ``unit='K'`` inputs are converted first.  ``compat``
    applies the formula to the inputs as given (the reference feeds Kelvin
    straight in).
    """
    td, t = _c(td), _c(t)
    if unit == "K" and not compat:
        td, t = td - KELVIN_OFFSET, t - KELVIN_OFFSET
    num = F.exp(F.lit(MAGNUS_A) * td / (F.lit(MAGNUS_B) + td))
    den = F.exp(F.lit(MAGNUS_A) * t / (F.lit(MAGNUS_B) + t))
    return F.lit(100.0) * num / den


def mean_two_times(a, b) -> Column:
    """Mean of the 00 and 12 UTC values; null if either is null."""
    return (_c(a) + _c(b)) / 2.0


# ------------------------------------------------------------ P16 clamp
def clamp_min(col, lo: float = 0.0) -> Column:
    """Clamp values below ``lo`` to ``lo`` keeping nulls."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(c, F.lit(lo)))


# ------------------------------------------------------------ P19 time shift
def shift_time(col, hours: int = -1) -> Column:
    """Shift a timestamp by whole hours (P19: valid time -> utctime is -1)."""
    return _c(col) + F.make_dt_interval(hours=F.lit(hours))


# ------------------------------------------------------------ P20 labels
def month_label(col) -> Column:
    """``YYYY-MM`` label of a date/timestamp (P20)."""
    return F.date_format(_c(col), "yyyy-MM")


def month_name(col) -> Column:
    """Full English month name (P20)."""
    return F.date_format(_c(col), "MMMM")


def day_label(col) -> Column:
    """``dd.mm.yyyy`` label (P20)."""
    return F.date_format(_c(col), "dd.MM.yyyy")


# ------------------------------------------------------------ P21 haversine
def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance on a sphere of radius 6371 km."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dlmb = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(a > 1, F.lit(1.0)).otherwise(a)))


# ------------------------------------------------------------ P22 features
_POINT_SUFFIX = r"^(.*)-([1-4])$"


def feature_point(col) -> Column:
    """Grid point of a feature name ending in ``-1``..``-4``, else 'Other' (P22)."""
    c = _c(col)
    return F.when(c.rlike(_POINT_SUFFIX), F.regexp_extract(c, _POINT_SUFFIX, 2)).otherwise(F.lit("Other"))


def feature_base(col) -> Column:
    """Base variable of a feature name: the name without a ``-[1-4]`` suffix."""
    c = _c(col)
    return F.when(c.rlike(_POINT_SUFFIX), F.regexp_extract(c, _POINT_SUFFIX, 1)).otherwise(c)


# ------------------------------------------------------------ P26 bands
def member_band(col, width: int = 10) -> Column:
    """Ensemble member band: 0 -> '0' (control), else '1-10', '11-20', ...."""
    m = _c(col).cast("long")
    lo = F.floor((m - 1) / width) * width + 1
    return F.when(m == 0, F.lit("0")).otherwise(
        F.concat(lo.cast("string"), F.lit("-"), (lo + width - 1).cast("string")))


def scott_bandwidth(sd: Column, n: Column) -> Column:
    """Scott's rule factor n^(-1/5) times the sample standard deviation."""
    return sd * F.pow(n.cast("double"), F.lit(-0.2))


SQRT_2PI = math.sqrt(2 * math.pi)
