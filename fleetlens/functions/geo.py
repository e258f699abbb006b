"""Great-circle distance as native column expressions.

The reference evaluates haversine in a row-at-a-time Python UDF; here it is
plain Catalyst arithmetic, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius used by the reference.
EARTH_RADIUS_M = 6371000.0
EARTH_RADIUS_KM = 6371.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _half_sine_square(degrees: Column) -> Column:
    """sin(x / 2) squared, by the half-angle formula's numerically safe form."""
    half = F.sin(F.radians(degrees) / 2.0)
    return half * half


def haversine_raw(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance; NULL if any input is NULL. Rounding can lift the
    chord term over one at antipodes, so it is held there."""
    from_lat, from_lon, to_lat, to_lon = map(_col, (lat1, lon1, lat2, lon2))
    shrink = F.cos(F.radians(from_lat)) * F.cos(F.radians(to_lat))
    chord = _half_sine_square(to_lat - from_lat) + shrink * _half_sine_square(to_lon - from_lon)
    # ``least`` skips NULLs, so a NULL chord is kept apart.
    chord = F.when(chord.isNotNull(), F.least(chord, F.lit(1.0)))
    return 2.0 * radius * F.atan2(F.sqrt(chord), F.sqrt(1.0 - chord))


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Metres between two points; 0.0 when any coordinate is NULL (as the
    reference's helper returns)."""
    return F.coalesce(haversine_raw(lat1, lon1, lat2, lon2, EARTH_RADIUS_M), F.lit(0.0))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Kilometres, radius 6371 km (map segments)."""
    return haversine_raw(lat1, lon1, lat2, lon2, EARTH_RADIUS_KM)
