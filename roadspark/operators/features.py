"""Feature extraction: from features to the four tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.tags import calming_type, kept_tags, split_values, surface_type, way_id_of, way_surface
from ..schemas import tag
from ..vocabulary import CALMING, MINI_ROUNDABOUT_RADIUS
from . import filters as f


def _calming_row(kind: Column, at: Column, end: Column | None = None, way_id: Column | None = None) -> Column:
    ends = [end["lat"].alias("end_lat"), end["lon"].alias("end_lon")] if end is not None else [F.lit(None).cast("double").alias(c) for c in ("end_lat", "end_lon")]
    way = (way_id if way_id is not None else F.lit(None)).cast("bigint").alias("way_id")
    return F.struct(at["lat"].alias("lat"), at["lon"].alias("lon"), kind.alias("type"), *ends, way, kept_tags().alias("tags"))


def _first() -> Column:
    return F.element_at("pts", 1)


def calming_rows() -> Column:
    """Traffic calming at a point: one row for each known value, in the tag's order."""
    known = F.filter(split_values(tag("traffic_calming")), lambda v: v.isin(*CALMING))
    rows = F.transform(known, lambda v: _calming_row(calming_type(v), _first()))
    return F.when(f.is_point() & f.tagged("traffic_calming"), rows)


def camera_rows() -> Column:
    return F.when(f.is_point() & f.speed_camera(), F.array(_calming_row(F.lit("speed_camera"), _first())))


def bridge_rows() -> Column:
    kind = F.when(f.is_value(tag("bridge"), "yes"), "bridge").otherwise("tunnel")
    return F.when(f.is_line() & f.bridge_or_tunnel(), F.array(_calming_row(kind, _first(), F.element_at("pts", -1), way_id_of(F.col("id")))))


def calming_rules() -> list[Column]:
    return [calming_rows(), camera_rows(), bridge_rows()]


def roundabout_rules() -> list[Column]:
    return [mini_roundabout_rows(), roundabout_rows()]


def _emit(features: DataFrame, *rules: Column) -> DataFrame:
    """The union of what the rules give for each feature, in one pass."""
    usable = features.where(F.size("pts") > 0)
    return usable.select("region", F.explode(F.flatten(F.array_compact(F.array(*rules)))).alias("row")).select("region", "row.*")


def traffic_calming(features: DataFrame, *, calming: bool = True, cameras: bool = True, bridges: bool = True) -> DataFrame:
    """Calming points, speed cameras, bridges and tunnels. A feature may give several rows."""
    chosen = [rule for on, rule in ((calming, calming_rows()), (cameras, camera_rows()), (bridges, bridge_rows())) if on]
    return _emit(features, *chosen)


def _round_row(lat: Column, lon: Column, radius: Column, kind: str) -> Column:
    return F.struct(lat.alias("lat"), lon.alias("lon"), radius.cast("double").alias("radius"), F.lit(kind).alias("type"))


def mini_roundabout_rows() -> Column:
    return F.when(f.is_point() & f.mini_roundabout(), F.array(_round_row(_first()["lat"], _first()["lon"], F.lit(MINI_ROUNDABOUT_RADIUS), "mini_roundabout")))


def roundabout_rows() -> Column:
    """Centre and radius of roundabouts, open lines and rings (their outer ring) alike."""
    lat, lon = (geo.vertex_mean(F.col("pts"), axis) for axis in ("lat", "lon"))
    radius = F.round(geo.farthest(F.col("pts"), lat, lon))
    return F.when((f.is_line() | f.is_polygon()) & f.roundabout(), F.array(_round_row(lat, lon, radius, "roundabout")))


def roundabouts(features: DataFrame, *, mini: bool = True, full: bool = True) -> DataFrame:
    return _emit(features, *[rule for on, rule in ((mini, mini_roundabout_rows()), (full, roundabout_rows())) if on])


def _with_bounds(features: DataFrame) -> DataFrame:
    """Bounds come from the assembly if that made the features, else from the vertices."""
    features = features.withColumn("coords", geo.flat_coords(F.col("pts")))
    return features if "min_lat" in features.columns else features.withColumns(geo.flat_bbox(F.col("coords")))


_BOUNDS = ["coords", "min_lat", "max_lat", "min_lon", "max_lon"]


def is_road_way(service_filter: bool = True) -> Column:
    return f.is_line() & f.tagged("highway") & f.enough_vertices() & (f.public_service() if service_filter else F.lit(True))


def is_road_surface(service_filter: bool = True) -> Column:
    return f.is_line() & f.tagged("surface") & f.enough_vertices() & (f.public_service() if service_filter else F.lit(True))


def road_ways(features: DataFrame, service_filter: bool = True, with_surface: bool = True) -> DataFrame:
    """Roads with their surface (null if missing or unknown) and bounds; drop the private
    service roads and the surface by the two options for the plain variant."""
    rows = features.where(is_road_way(service_filter))
    surface = [way_surface(tag("surface")).alias("surface")] if with_surface else []
    return _with_bounds(rows).select("region", *[c for c in ("way_id",) if c in rows.columns], tag("highway").alias("highway"), *surface, *_BOUNDS)


def road_surfaces(features: DataFrame, service_filter: bool = True) -> DataFrame:
    """Roads with a surface tag, normalised (unknown values stay, as ``unknown``), and bounds."""
    rows = features.where(is_road_surface(service_filter))
    return _with_bounds(rows).select("region", *[c for c in ("way_id",) if c in rows.columns], surface_type(tag("surface")).alias("surface"), *_BOUNDS)


def core(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables of the core extract: traffic calming and roundabouts."""
    return traffic_calming(features), roundabouts(features)
