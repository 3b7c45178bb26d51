"""Great-circle distance as a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, form: str = "atan2") -> Column:
    """Distance in km between two points in degrees; null if any coordinate is null.

    ``form`` picks between two algebraically equal closings that differ in the last bits:
    ``atan2`` (used for ping-to-ping distance) and ``asin`` (used for route length).
    """
    if form == "atan2":
        half_dlat = F.radians(lat2 - lat1) / 2
        half_dlon = F.radians(lon2 - lon1) / 2
    elif form == "asin":
        half_dlat = (F.radians(lat2) - F.radians(lat1)) / 2
        half_dlon = (F.radians(lon2) - F.radians(lon1)) / 2
    else:
        raise ValueError(f"unknown form {form!r}: use 'atan2' or 'asin'")

    raw = F.pow(F.sin(half_dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_dlon), 2
    )
    # rounding can push antipodal points past 1; least() would turn null into 1, this keeps null
    a = F.when(raw > 1, F.lit(1.0)).otherwise(raw)
    if form == "atan2":
        return F.lit(EARTH_RADIUS_KM) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))
