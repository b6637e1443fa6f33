"""Great-circle distance as a Spark column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0


def haversine_km(
    lat1: Column | str,
    lon1: Column | str,
    lat2: Column | str,
    lon2: Column | str,
    radius_km: float = EARTH_RADIUS_KM,
) -> Column:
    """Haversine distance in km between two points given in degrees.

    Uses the arcsine form ``2 r asin(sqrt(h))``; any null input gives null.
    """
    phi1 = F.radians(lat1)
    phi2 = F.radians(lat2)
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = (F.radians(lon2) - F.radians(lon1)) / 2
    h = F.pow(F.sin(half_dphi), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlambda), 2)
    return F.lit(radius_km) * (2 * F.asin(F.sqrt(h)))
