"""Great-circle geometry as Column expressions.

Everything here is plain ``pyspark.sql.functions``, so it runs JVM-side both in
projections (inside whole-stage codegen) and inside array lambdas. Latitudes
and longitudes are degrees; lengths come back in the requested unit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius per unit, kilometres / statute miles /
# nautical miles.
EARTH_RADIUS = {"K": 6371.009, "M": 3958.761, "N": 3440.069}


def earth_radius(unit: str) -> float:
    """Radius for a unit code; an unknown code means kilometres."""
    return EARTH_RADIUS.get(unit, EARTH_RADIUS["K"])


def central_angle(lat1, lon1, lat2, lon2, compat: bool = False) -> Column:
    """Haversine central angle between two points, in radians.

    ``compat=True`` reproduces a known defect: any two points of exactly equal
    latitude are taken to be the same point.
    """
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    # Squares by pow, and a closing asin rather than atan2, so that no part is
    # written twice: array lambdas have no common subexpression elimination.
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    h = F.pow(half_dlat, F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        half_dlon, F.lit(2.0)
    )
    # Rounding can push h past 1 for antipodal points.
    angle = F.lit(2.0) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))
    if compat:
        return F.when(lat1 == lat2, F.lit(0.0)).otherwise(angle)
    return angle


def distance(lat1, lon1, lat2, lon2, unit: str = "K", compat: bool = False) -> Column:
    """Great-circle distance between two points."""
    return central_angle(lat1, lon1, lat2, lon2, compat) * F.lit(earth_radius(unit))


def bearing(lat1, lon1, lat2, lon2) -> Column:
    """Initial bearing from the first point to the second, radians in (-pi, pi]."""
    lat1, lon1, lat2, lon2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    east = F.sin(lon2 - lon1) * F.cos(lat2)
    north = F.cos(lat1) * F.sin(lat2) - F.sin(lat1) * F.cos(lat2) * F.cos(lon2 - lon1)
    return F.atan2(east, north)


def cross_track(
    a_lat, a_lon, b_lat, b_lon, p_lat, p_lon, unit: str = "K", compat: bool = False
) -> Column:
    """Signed distance of P from the great circle through A and B.

    Positive to the right of A->B. The circle is endless: P may lie far beyond
    either end of the leg and still be close to the circle.
    """
    turn = bearing(a_lat, a_lon, p_lat, p_lon) - bearing(a_lat, a_lon, b_lat, b_lon)
    angle = central_angle(a_lat, a_lon, p_lat, p_lon, compat)
    return F.asin(F.sin(angle) * F.sin(turn)) * F.lit(earth_radius(unit))


def speed_per_hour(length, start_ts, end_ts) -> Column:
    """Average speed, length units per hour, for a leg timed in epoch seconds.

    NULL for a leg that takes no time.
    """
    return F.try_divide(_col(length) * 3600.0, _col(end_ts) - _col(start_ts))


def _col(c) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(c) if isinstance(c, str) else F.lit(float(c))
