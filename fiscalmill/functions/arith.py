"""NULL-safe arithmetic, buckets and great-circle distance."""

from __future__ import annotations

from functools import reduce
from operator import add, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in miles, and kilometres per mile.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _zero_for_null(fields) -> list[Column]:
    if not fields:
        raise ValueError("at least one field is needed")
    return [F.coalesce(_column(f), F.lit(0)) for f in fields]


def safe_add(*fields: str | Column) -> Column:
    """Sum of the fields, NULL counted as 0."""
    return reduce(add, _zero_for_null(fields))


def safe_subtract(*fields: str | Column) -> Column:
    """First field minus all others, NULL counted as 0."""
    return reduce(sub, _zero_for_null(fields))


def safe_divide(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient, NULL when the denominator is 0 or either side is NULL."""
    return F.try_divide(_column(numerator), _column(denominator))


def width_bucket(value: str | Column, low, high, n: int) -> Column:
    """Left-closed equal-width bucket 1..n; 0 below ``low``, n+1 from ``high`` on."""
    return F.width_bucket(_column(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(n))


def degrees_to_radians(degrees: str | Column) -> Column:
    return F.radians(_column(degrees))


def haversine_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance between two points given in degrees."""
    rates = {"mi": 1.0, "km": KM_PER_MILE}
    if unit not in rates:
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    phi1, lam1, phi2, lam2 = (degrees_to_radians(c) for c in (lat1, lon1, lat2, lon2))
    half_chord = (
        F.pow(F.sin((phi2 - phi1) / 2), 2)
        + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin((lam2 - lam1) / 2), 2)
    )
    return F.asin(F.sqrt(half_chord)) * (2 * EARTH_RADIUS_MILES * rates[unit])
