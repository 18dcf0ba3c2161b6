"""Geography as column expressions; degrees in, kilometres or degrees out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.19492664455873  # EARTH_RADIUS_KM * pi / 180


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; rounding errors above the antipode are clamped."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # not least(): it skips NULL and would turn a missing point into half the globe
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(chord > 1.0, F.lit(1.0)).otherwise(chord)))


def bearing_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial heading from the first to the second point, in [0, 360)."""
    turn = F.radians(lon2) - F.radians(lon1)
    east = F.sin(turn) * F.cos(F.radians(lat2))
    north = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(turn)
    return F.pmod(F.degrees(F.atan2(east, north)) + 360, F.lit(360.0))


def grid_cell(lat: Column, lon: Column, size: float) -> tuple[Column, Column]:
    """Integer row and column of a square grid with ``size`` degrees per cell."""
    return F.floor(lat / F.lit(size)), F.floor(lon / F.lit(size))


def along_route(start: Column, end: Column, fraction: Column) -> Column:
    """One coordinate of the point at ``fraction`` (clamped to 0..1) of a straight route."""
    clamped = F.when(fraction < 0.0, 0.0).when(fraction > 1.0, 1.0).otherwise(fraction)
    return start + (end - start) * clamped
