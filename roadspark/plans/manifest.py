"""The manifest of published artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import time

_SUFFIX = ".json.gz"
_SIBLINGS = {"surface": "-surfaces.json.gz", "way": "-ways.json.gz", "sqlite": ".sqlite.gz"}


def checksum16(content: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of some bytes."""
    return F.substring(F.sha2(content, 256), 1, 16)


def is_core(file: Column) -> Column:
    return file.endswith(_SUFFIX) & ~file.contains("-surfaces") & ~file.contains("-ways")


def region_of(file: Column) -> Column:
    """The file name up to its first ``.json.gz``."""
    return F.regexp_extract(file, r"^(.*?)\.json\.gz", 1)


def region_names(regions: DataFrame) -> DataFrame:
    """One name for each id: the last one of the catalogue, by its ``position``."""
    return regions.groupBy("id").agg(F.max_by("name", "position").alias("name"))


def manifest_regions(artifacts: DataFrame, regions: DataFrame) -> DataFrame:
    """A row for each region with a core artifact: name, and size and checksum of each kind.

    Absent siblings have nulls; siblings without a core artifact are left out. Checksums are
    taken where the files are read; only names, sizes and checksums are shuffled.
    """
    files = artifacts.select("file", "size", checksum16(F.col("content")).alias("checksum"))
    region, kind = F.when(is_core(F.col("file")), region_of(F.col("file"))), F.when(is_core(F.col("file")), F.lit("core"))
    for name, suffix in _SIBLINGS.items():
        match = F.col("file").endswith(suffix) & ~is_core(F.col("file"))
        region = region.when(match, F.expr(f"left(file, length(file) - {len(suffix)})"))
        kind = kind.when(match, F.lit(name))
    kinds = files.select(region.alias("region"), kind.alias("kind"), "size", "checksum").where("region is not null")
    one = [F.max(F.when(F.col("kind") == k, F.col(c))).alias(c if k == "core" else f"{k}_{c}") for k in ("core", *_SIBLINGS) for c in ("size", "checksum")]
    found = kinds.groupBy("region").agg(*one).where("size is not null")
    named = found.join(region_names(regions).withColumnRenamed("id", "region"), "region", "left")
    return named.withColumn("name", F.coalesce(F.nullif("name", F.lit("")), "region"))


def totals(manifest: DataFrame) -> DataFrame:
    """Regions and published bytes; database files do not count."""
    size = F.col("size") + F.coalesce("surface_size", F.lit(0)) + F.coalesce("way_size", F.lit(0))
    return manifest.agg(F.count("*").alias("n_regions"), F.coalesce(F.sum(size), F.lit(0)).alias("total_bytes"))


def manifest_document(manifest: DataFrame, version: str | None = None, generated_at: str | None = None) -> DataFrame:
    """One row ``value``: the manifest as JSON. Absent siblings have no key; a row a region."""
    names = {"surface_size": "surfaceSize", "surface_checksum": "surfaceChecksum", "way_size": "waySize", "way_checksum": "wayChecksum", "sqlite_size": "sqliteSize", "sqlite_checksum": "sqliteChecksum"}
    entry = F.struct("name", "size", "checksum", *[F.col(a).alias(b) for a, b in names.items()])
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("region", entry))))
    return manifest.agg(entries.alias("regions")).select(F.to_json(F.struct(time.version(version).alias("version"), time.instant(generated_at).alias("generatedAt"), "regions")).alias("value"))


def slim_document(regions: DataFrame, version: str | None = None, generated_at: str | None = None) -> DataFrame:
    """One row ``value``: the slim catalogue as JSON, in the catalogue's order."""
    entry = F.struct("id", "name", "bbox", "estimatedSize")
    position = F.col("position") if "position" in regions.columns else F.col("id")
    listed = F.transform(F.array_sort(F.collect_list(F.struct(position.alias("at"), entry.alias("entry")))), lambda x: x["entry"])
    return regions.agg(listed.alias("regions")).select(F.to_json(F.struct(time.version(version).alias("version"), time.instant(generated_at).alias("generatedAt"), "regions")).alias("value"))
