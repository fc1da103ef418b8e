"""From element tables to the finished tables, for all regions at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import time
from ..operators import features as x
from ..operators import filters as f
from ..operators.geometry import assemble_geometry, point_features
from ..storage import saved


def road_features(ways: DataFrame, nodes: DataFrame, way_nodes: DataFrame | None = None, **options) -> DataFrame:
    """Drivable ways with geometry: the base of road_ways and road_surfaces."""
    return assemble_geometry(ways.where(f.drivable()), nodes, way_nodes, **options)


def core_features(ways: DataFrame, nodes: DataFrame, way_nodes: DataFrame | None = None, **options) -> DataFrame:
    """Features of the core extract: elements that a core rule selects."""
    lines = assemble_geometry(f.tag_filter(ways, "w"), nodes, way_nodes, **options)
    columns = ["region", "id", "geom_type", "tags", "pts"]
    return point_features(f.tag_filter(nodes, "n")).select(columns).unionByName(lines.select(columns))


def line_features(ways: DataFrame, nodes: DataFrame, way_nodes: DataFrame | None = None, **options) -> DataFrame:
    """Every way that any table needs, with geometry: assembled once."""
    return assemble_geometry(ways.where(f.drivable() | f.tag_condition("w", f.CORE_RULES)), nodes, way_nodes, **options)


def extract(ways: DataFrame, nodes: DataFrame, way_nodes: DataFrame | None = None, **options) -> dict[str, DataFrame]:
    """The four feature tables. The geometry is assembled once and saved, for all of them."""
    lines = saved(line_features(ways, nodes, way_nodes, **options), "lines")
    columns = ["region", "id", "geom_type", "tags", "pts"]
    core = point_features(f.tag_filter(nodes, "n")).select(columns).unionByName(f.tag_filter(lines, "w").select(columns))
    calming, rounds = x.core(core)
    roads = lines.where(f.drivable())
    return {"traffic_calming": calming, "roundabouts": rounds, "road_ways": x.road_ways(roads).drop("way_id"), "road_surfaces": x.road_surfaces(roads.where(f.has_surface())).drop("way_id")}


TABLES = ("traffic_calming", "roundabouts", "road_ways", "road_surfaces")


def region_counts(tables: dict[str, DataFrame], regions: DataFrame) -> DataFrame:
    """region, table, n for every region of ``regions`` and every table, zero included."""
    every = reduce(DataFrame.unionByName, [df.select("region", F.lit(name).alias("table")) for name, df in tables.items()])
    return _for_each_region(every.groupBy("region").pivot("table", list(tables)).count(), tables, regions)


def _for_each_region(counts: DataFrame, tables, regions: DataFrame) -> DataFrame:
    """Wide counts of some regions as rows of all regions."""
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("table"), F.coalesce(t, F.lit(0)).cast("bigint").alias("n")) for t in tables]))
    return regions.select("region").distinct().join(counts, "region", "left").select("region", rows.alias("row")).select("region", "row.*")


def counted(ways: DataFrame, nodes: DataFrame, way_nodes: DataFrame | None = None, **options) -> DataFrame:
    """The region counts straight from the elements: one assembly and one aggregate, no tables."""
    lines = line_features(ways, nodes, way_nodes, **options)
    columns = ["region", "id", "geom_type", "tags", "pts"]
    features = point_features(f.tag_filter(nodes, "n")).select(columns).unionByName(lines.select(columns))
    is_node, is_core = f.is_point(), f.tag_condition("w", f.CORE_RULES)
    emitted = lambda *rules: F.aggregate(F.array(*[F.coalesce(F.size(r), F.lit(0)) for r in rules]), F.lit(0), lambda s, n: s + n)
    numbers = {
        "traffic_calming": F.sum(F.when(is_node | is_core, emitted(*x.calming_rules()))),
        "roundabouts": F.sum(F.when(is_node | is_core, emitted(*x.roundabout_rules()))),
        "road_ways": F.count_if(f.drivable() & x.is_road_way()),
        "road_surfaces": F.count_if(f.drivable() & x.is_road_surface()),
    }
    counts = features.where(F.size("pts") > 0).groupBy("region").agg(*[n.alias(t) for t, n in numbers.items()])
    return _for_each_region(counts, TABLES, ways.select("region"))


def metadata(counts: DataFrame, version: str | None = None, created_at: str | None = None) -> DataFrame:
    """The long-form metadata of each region, from the counts of its tables."""
    flags = counts.groupBy("region").agg(*[(F.max(F.when(F.col("table") == t, F.col("n"))) > 0).cast("string").alias(name) for t, name in (("road_surfaces", "surfaces"), ("road_ways", "ways"))])
    pairs = [("version", time.version(version)), ("region", F.col("region")), ("createdAt", time.instant(created_at)), ("hasSurfaceData", F.coalesce("surfaces", F.lit("false"))), ("hasWayData", F.coalesce("ways", F.lit("false")))]
    return flags.select("region", F.explode(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs])).alias("p")).select("region", "p.key", "p.value")
