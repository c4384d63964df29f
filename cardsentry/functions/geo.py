"""Great-circle distance as a native Column expression."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: mean Earth radius in kilometres used by the distance features.
EARTH_RADIUS_KM = 6371.0


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km; NULL if any input is NULL.

    The square-root argument is clamped to 1 so rounding noise on antipodal
    points cannot push ``asin`` outside its domain.
    """
    lat1, lon1, lat2, lon2 = _c(lat1), _c(lon1), _c(lat2), _c(lon2)
    dphi = F.radians(lat2 - lat1)
    dlmb = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dphi / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlmb / 2), 2))
    # Clamp with CASE, not least(): least() skips NULLs and would turn a
    # missing point into a half-circumference distance.
    clamped = F.when(a > 1.0, F.lit(1.0)).otherwise(a)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(clamped))
