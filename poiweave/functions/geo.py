"""Distances, boxes, bins and the polygon test, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
#: The radius of the graph store's point distance.
GRAPH_EARTH_M = 6_378_140.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_M) -> Column:
    p, q = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((q - p) / 2), 2) + F.cos(p) * F.cos(q) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def flat_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, at: Column | None = None) -> Column:
    """Equirectangular metres; the cosine is taken at the mean latitude, or at ``at``."""
    y = (lat1 - lat2) * F.lit(111_320.0)
    x = (lon1 - lon2) * F.lit(40_075_000.0) * F.cos(F.radians(at if at is not None else (lat1 + lat2) / 2)) / F.lit(360.0)
    return F.sqrt(x * x + y * y)


def in_box(lat: Column, lon: Column, min_lat: Column, min_lon: Column, max_lat: Column, max_lon: Column) -> Column:
    """Closed box; null if a bound is null."""
    return lat.between(min_lat, max_lat) & lon.between(min_lon, max_lon)


def repaired_box(a: Column, b: Column, c: Column, d: Column) -> list[Column]:
    """min_lat, min_lon, max_lat, max_lon with swapped bounds put right; a side with a null stays as it is."""
    both = lambda f, x, y: F.when(x.isNotNull() & y.isNotNull(), f(x, y))
    return [F.coalesce(both(F.least, a, c), a), F.coalesce(both(F.least, b, d), b), F.coalesce(both(F.greatest, a, c), c), F.coalesce(both(F.greatest, b, d), d)]


def buffer_degrees(lat: Column, km: float) -> tuple[Column, Column]:
    """Degrees of latitude and longitude that span ``km`` at a latitude (cosine floored at 0.01)."""
    return F.lit(km / 111.32), F.lit(km) / (F.lit(111.32) * F.greatest(F.lit(0.01), F.abs(F.cos(F.radians(lat)))))


def in_buffered_box(lat: Column, lon: Column, box: tuple[Column, Column, Column, Column], km: float) -> Column:
    up, side = buffer_degrees(lat, km)
    return in_box(lat, lon, box[0] - up, box[1] - side, box[2] + up, box[3] + side)


def crosses(lat: Column, lon: Column, lat_i: Column, lon_i: Column, lat_j: Column, lon_j: Column) -> Column:
    """An upward ray from the point crosses this polygon side; an odd number of crossings is inside."""
    return ((lon_i > lon) != (lon_j > lon)) & (lat < (lat_j - lat_i) * (lon - lon_i) / ((lon_j - lon_i) + F.lit(1e-12)) + lat_i)


def in_polygon(lat: Column, lon: Column, polygon: Column) -> Column:
    """Even-odd test against an array of struct(lat, lon); fewer than three corners is outside."""
    n = F.size(polygon)
    hits = F.aggregate(
        F.sequence(F.lit(0), n - 1), F.lit(0),
        lambda acc, i: acc + crosses(lat, lon, F.get(polygon, i)["lat"], F.get(polygon, i)["lon"], F.get(polygon, F.pmod(i - 1, n))["lat"], F.get(polygon, F.pmod(i - 1, n))["lon"]).cast("int"),
    )
    return F.when(polygon.isNotNull() & (n >= 3), hits % 2 == 1).otherwise(F.lit(False))


def grid_bin(x: Column, per_degree: float = 100.0) -> Column:
    """Half-even rounded bin."""
    return F.rint(x * F.lit(per_degree)).cast("long")


def floor_bin(x: Column, size: float) -> Column:
    return F.floor(x / F.lit(size)).cast("long")
