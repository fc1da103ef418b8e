"""Filters on elements and features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tags import is_value, present
from ..schemas import tag
from ..vocabulary import DRIVABLE, PRIVATE_SERVICE

#: What the core extract selects: element kinds (n, w), tag, values (any if none).
CORE_RULES = [
    ("n", "traffic_calming", ()),
    ("n", "highway", ("speed_camera",)),
    ("n", "enforcement", ("maxspeed",)),
    ("w", "bridge", ("yes",)),
    ("w", "tunnel", ("yes",)),
    ("nw", "junction", ("roundabout",)),
    ("n", "highway", ("mini_roundabout",)),
]


def tag_condition(kind: str, rules: list[tuple]) -> Column:
    """Does an element of this kind (n or w) fulfil one of the rules?"""
    tests = [is_value(tag(key), *values) if values else tag(key).isNotNull() for kinds, key, values in rules if kind in kinds]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def tag_filter(elements: DataFrame, kind: str, rules: list[tuple] = CORE_RULES) -> DataFrame:
    return elements.where(tag_condition(kind, rules))


def drivable() -> Column:
    return is_value(tag("highway"), *DRIVABLE)


def has_surface() -> Column:
    return tag("surface").isNotNull()


def public_service() -> Column:
    """Not a service road of a private kind."""
    return ~(is_value(tag("highway"), "service") & is_value(tag("service"), *PRIVATE_SERVICE))


def speed_camera() -> Column:
    return is_value(tag("highway"), "speed_camera") | is_value(tag("enforcement"), "maxspeed")


def mini_roundabout() -> Column:
    return is_value(tag("highway"), "mini_roundabout")


def roundabout() -> Column:
    return is_value(tag("junction"), "roundabout")


def bridge_or_tunnel() -> Column:
    return is_value(tag("bridge"), "yes") | is_value(tag("tunnel"), "yes")


def is_point() -> Column:
    return F.col("geom_type") == "Point"


def is_line() -> Column:
    return F.col("geom_type") == "LineString"


def is_polygon() -> Column:
    return F.col("geom_type") == "Polygon"


def enough_vertices() -> Column:
    return F.size("pts") >= 2


def tagged(name: str) -> Column:
    return present(tag(name))
