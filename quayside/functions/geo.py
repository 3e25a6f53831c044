"""Distances as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.config import EARTH_KM


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = F.pow(F.sin(dlat / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), F.lit(2))
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def flat_nm(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Equirectangular distance in nautical miles; longitudes wrap at the date line."""
    dlat = lat2 - lat1
    x = lon2 - lon1 + 180
    dlon = x - F.floor(x / 360) * 360 - 180
    return F.hypot(dlat, F.cos(F.radians((lat1 + lat2) / 2)) * dlon) * 60
