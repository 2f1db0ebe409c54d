"""Distances and grids on the sphere, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_009.0
#: The cell splitter works with another radius and formula than the rest.
SPLITTER_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.32
WALK_KMH = 3.0


def _half_chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column, degrees: bool) -> Column:
    if degrees:
        lat1, lon1, lat2, lon2 = map(F.radians, (lat1, lon1, lat2, lon2))
    square = lambda x: F.pow(F.sin(x / 2), F.lit(2.0))
    return square(lat2 - lat1) + F.cos(lat1) * F.cos(lat2) * square(lon2 - lon1)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, degrees: bool = True) -> Column:
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(_half_chord(lat1, lon1, lat2, lon2, degrees))))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, degrees: bool = True) -> Column:
    return haversine_m(lat1, lon1, lat2, lon2, degrees) / 1000


def splitter_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = _half_chord(lat1, lon1, lat2, lon2, True)
    return 2 * SPLITTER_RADIUS_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def walk_minutes(km: Column, kmh: float = WALK_KMH) -> Column:
    return km / kmh * 60


def lon_km_per_degree(lat: Column) -> Column:
    return KM_PER_DEGREE * F.greatest(F.abs(F.cos(F.radians(lat))), F.lit(1e-6))


def buffer_lat_degrees(km: float) -> float:
    return km / KM_PER_DEGREE


def cell_of(degree: Column) -> Column:
    return F.floor(degree).cast("int")


def grid_of(degree: Column, radius_m: float) -> Column:
    """Fine grid index: cells of 1.5 radii."""
    return F.floor(degree / (1.5 * radius_m / 111_320.0)).cast("long")


def max_lon_degrees(radius_m: float, lat: float) -> float:
    """Widest longitude difference of two points within the radius when one of them is at most at this latitude."""
    return math.degrees(radius_m / EARTH_RADIUS_M) / max(math.cos(math.radians(min(90.0, abs(lat)))), 1e-9)
