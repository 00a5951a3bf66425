"""Positions, distances, headings and units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The box rule of the ingestion side.
NM_PER_DEGREE = 60.0
MIN_COS_LAT = 0.01

EARTH_RADIUS_NM = 3440.065
FT_PER_M = 3.280839895013123
KT_PER_MS = 1.9438444924406046


def m_to_ft(c: Column) -> Column:
    return c * F.lit(FT_PER_M)


def ms_to_kt(c: Column) -> Column:
    return c * F.lit(KT_PER_MS)


def bounding_box(lat: Column, lon: Column, radius_nm: float) -> Column:
    """Clamped rectangle around a point as a struct; no wrap at the antimeridian."""
    if radius_nm <= 0:
        raise ValueError(f"a box needs a radius above zero; {radius_nm} nm is none")
    dlat = F.lit(radius_nm / NM_PER_DEGREE)
    dlon = F.lit(radius_nm) / (
        F.lit(NM_PER_DEGREE) * F.greatest(F.cos(F.radians(lat)), F.lit(MIN_COS_LAT))
    )
    return F.struct(
        F.greatest(lat - dlat, F.lit(-90.0)).alias("lamin"),
        F.least(lat + dlat, F.lit(90.0)).alias("lamax"),
        F.greatest(lon - dlon, F.lit(-180.0)).alias("lomin"),
        F.least(lon + dlon, F.lit(180.0)).alias("lomax"),
    )


def in_bbox(lat: Column, lon: Column, box: Column) -> Column:
    inside = lat.between(box["lamin"], box["lamax"]) & lon.between(box["lomin"], box["lomax"])
    return F.coalesce(inside, F.lit(False))


def distance_nm(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_NM) * F.asin(F.least(F.sqrt(a), F.lit(1.0)))


def heading_delta(a: Column, b: Column) -> Column:
    """Signed turn from ``a`` to ``b`` in [-180, 180)."""
    return F.pmod(b - a + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def crosswind_kt(direction: Column, speed_kt: Column, runway_deg: Column) -> Column:
    return F.abs(speed_kt * F.sin(F.radians(direction - runway_deg)))


def least_crosswind_kt(direction: Column, speed_kt: Column, headings: Column) -> Column:
    """Smallest crosswind over an array of runway headings; null without any."""
    return F.array_min(F.transform(headings, lambda h: crosswind_kt(direction, speed_kt, h)))


def lon_reach_deg(lat: Column, radius_nm: float) -> Column:
    """Half-width in degrees of longitude of a circle of ``radius_nm`` at ``lat``."""
    r = radius_nm / EARTH_RADIUS_NM
    ratio = F.sin(F.lit(r)) / F.greatest(F.cos(F.radians(lat)), F.lit(1e-9))
    return F.when(ratio >= 1, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))))
