"""From bundles to the finished tables: the second step where features come as JSON bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import time
from ..functions.geo import flat_bbox
from ..sources import bundles

_CALMING = {"endLat": "end_lat", "endLon": "end_lon", "wayId": "way_id"}


def _bounded(items: DataFrame) -> DataFrame:
    return items.withColumns(flat_bbox(F.col("coords")))


def tables_from_bundles(spark: SparkSession, core: str, ways: str, surfaces: str, rounds: str | None = None, header: str | None = None, same_version: bool = True) -> dict[str, DataFrame]:
    """The four tables. The core bundle must exist; without the others their tables are empty.

    ``rounds`` names the roundabouts where they are lines in a folder of their own, ``header``
    the header table of a core in line form. Ways and surfaces whose version is not that of
    their region's core are an error of the job that reads them, as stale ones would go
    unnoticed; ``same_version=False`` takes them as they are.
    """
    calming = bundles.read_optional(spark, core, "trafficCalming", required=True).withColumnsRenamed(_CALMING)
    expected = bundles.versions(bundles.read_header(spark, core, header)) if same_version else None
    return {
        "traffic_calming": calming.select("region", "lat", "lon", "type", "end_lat", "end_lon", "way_id", "tags"),
        "roundabouts": bundles.read_optional(spark, rounds or core, "roundabouts", required=True),
        "road_surfaces": _bounded(bundles.read_optional(spark, surfaces, "roadSurfaces", expected=expected)),
        "road_ways": _bounded(bundles.read_optional(spark, ways, "roadWays", expected=expected)),
    }


def bundle_metadata(spark: SparkSession, core: str, tables: dict[str, DataFrame], created_at: str | None = None, header: str | None = None) -> DataFrame:
    """region, key, value: version and region of the core bundle, and what data a region has.

    With ``header`` every region of the run has its rows, one without any items too.
    """
    heads = bundles.read_header(spark, core, header)
    for table, flag in (("road_surfaces", "surfaces"), ("road_ways", "ways")):
        present = tables[table].select(F.coalesce("region", F.lit("")).alias("region")).distinct().withColumn(flag, F.lit("true"))
        heads = heads.join(present, "region", "left")
    pairs = [("version", F.col("version")), ("region", F.col("region")), ("createdAt", time.instant(created_at)), ("hasSurfaceData", F.coalesce("surfaces", F.lit("false"))), ("hasWayData", F.coalesce("ways", F.lit("false")))]
    return heads.select("region", F.explode(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs])).alias("p")).select("region", "p.key", "p.value")
