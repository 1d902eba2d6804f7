"""Distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value.
EARTH_RADIUS_KM = 6371


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance, unrounded; null when a coordinate is."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # Antipodes can leave a just above one. least() skips nulls, so they are kept out by hand.
    a = F.when(a.isNotNull(), F.least(a, F.lit(1.0)))
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, digits: int = 2) -> Column:
    return F.round(great_circle_km(lat1, lon1, lat2, lon2), digits)
