"""Schemas of the tables, in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vocabulary import TAGS

TAG_FIELDS = ", ".join(f"{t}: string" for t in TAGS)
NODES = f"region string, node_id long, lat double, lon double, tags struct<{TAG_FIELDS}>"
WAYS = f"region string, way_id long, id string, tags struct<{TAG_FIELDS}>"
WAY_NODES = "way_id long, seq long, node_id long"
#: ``pts``: array of (lon, lat) in order; a polygon's is its outer ring.
FEATURES = f"region string, id string, geom_type string, tags struct<{TAG_FIELDS}>, pts array<struct<lon: double, lat: double>>"
TRAFFIC_CALMING = "region string, lat double, lon double, type string, end_lat double, end_lon double, way_id long, tags map<string,string>"
ROUNDABOUTS = "region string, lat double, lon double, radius double, type string"
ROAD_SURFACES = "region string, surface string, coords array<double>, min_lat double, max_lat double, min_lon double, max_lon double"
ROAD_WAYS = "region string, highway string, surface string, coords array<double>, min_lat double, max_lat double, min_lon double, max_lon double"
METADATA = "region string, key string, value string"
REQUIRED = {
    "traffic_calming": ["lat", "lon", "type"],
    "roundabouts": ["lat", "lon", "type"],
    "road_surfaces": ["surface", "coords", "min_lat", "max_lat", "min_lon", "max_lon"],
    "road_ways": ["highway", "coords", "min_lat", "max_lat", "min_lon", "max_lon"],
    "metadata": ["key", "value"],
}


def tag_struct(df: DataFrame) -> Column:
    """The struct ``tags`` from columns of the tags' names; tags without a column are null."""
    return F.struct(*[(F.col(t) if t in df.columns else F.lit(None)).cast("string").alias(t) for t in TAGS])


def tag(name: str) -> Column:
    return F.col(f"tags.{name}")
