"""Column functions on coordinates. ``pts`` is an array of structs (lon, lat)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocabulary import EARTH_RADIUS_M


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres along a great circle."""
    half_lat, half_lon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), F.lit(2))
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def flat_coords(pts: Column) -> Column:
    """[lon, lat, lon, lat, ...]"""
    return F.flatten(F.transform(pts, lambda p: F.array(p["lon"], p["lat"])))


def vertex_mean(pts: Column, axis: str) -> Column:
    """The mean over all vertices, a repeated closing one included; null for no vertices."""
    total = F.aggregate(pts, F.lit(0.0), lambda s, p: s + p[axis])
    return F.when(F.size(pts) > 0, total / F.size(pts))


def farthest(pts: Column, lat: Column, lon: Column) -> Column:
    """The largest distance of a vertex from a place, in metres."""
    return F.greatest(F.lit(0.0), F.array_max(F.transform(pts, lambda p: haversine(lat, lon, p["lat"], p["lon"]))))


def length(pts: Column) -> Column:
    """Metres along the vertices."""
    steps = F.zip_with(F.slice(pts, F.lit(1), F.greatest(F.size(pts) - 1, F.lit(0))), F.slice(pts, F.lit(2), F.greatest(F.size(pts) - 1, F.lit(0))), lambda a, b: haversine(a["lat"], a["lon"], b["lat"], b["lon"]))
    return F.aggregate(steps, F.lit(0.0), lambda s, x: s + x)


def flat_bbox(coords: Column) -> dict[str, Column]:
    """The bounds of flat coordinates; a trailing value without a partner is ignored."""
    pairs = F.floor(F.size(coords) / 2).cast("int")

    def every_second(first: int) -> Column:
        return F.when(pairs > 0, F.transform(F.sequence(F.lit(0), pairs - 1), lambda i: F.get(coords, 2 * i + first)))

    lon, lat = every_second(0), every_second(1)
    return {"min_lat": F.array_min(lat), "max_lat": F.array_max(lat), "min_lon": F.array_min(lon), "max_lon": F.array_max(lon)}
