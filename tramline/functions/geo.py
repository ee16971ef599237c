"""Great-circle distance and speed as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius in metres (IUGG), the radius of the
# haversine distance the analyses are defined with.
EARTH_RADIUS_M = 6371008.8


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in metres between two (lat, lon) points in degrees."""
    phi1, phi2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = F.radians(_c(lat2) - _c(lat1))
    dlmb = F.radians(_c(lon2) - _c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(a))


def seconds_between(earlier, later) -> Column:
    """Seconds from ``earlier`` to ``later`` with microsecond precision."""
    return (F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))) / F.lit(1_000_000.0)
