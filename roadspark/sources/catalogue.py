"""The region catalogue and the published artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

REGION = "struct<id:string, name:string, continent:string, bbox:array<double>, geofabrikPath:string, estimatedSize:bigint>"


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """The regions of a catalogue document, with their position."""
    documents = spark.read.schema(f"regions array<{REGION}>").option("multiLine", True).json(path)
    return documents.select(F.posexplode("regions").alias("position", "r")).select("position", "r.*")


def find_region(regions: DataFrame, region_id: str) -> Row:
    """The first region with the id; an error if there is none."""
    found = regions.where(F.col("id") == region_id).orderBy(*[c for c in ("position",) if c in regions.columns]).first()
    if found is None:
        raise LookupError(f"unknown region: {region_id}")
    return found


def slim_regions(regions: DataFrame) -> DataFrame:
    """What apps need of a region."""
    return regions.select(*[c for c in ("position",) if c in regions.columns], "id", "name", "bbox", "estimatedSize")


def read_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """file, size, content of the files in a folder, not below it."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("size"), "content")
