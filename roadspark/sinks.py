"""Sinks: Parquet tables by region, bundles, documents.

What a run reports of its output is counted within the write: a writer that is given a
:class:`Written` leaves there the rows of each region and the bytes before compression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators.layout import checked, spatial_order
from .sources.bundles import HEADER, REGIONS
from .storage import partition_folder, remove, saved

#: Items that a single document may hold.
DOCUMENT_ITEMS = 1_000_000


@dataclass
class Written:
    """What a write counted: rows of each region that the run names, all rows, bytes as JSON."""

    regions: list[str] = field(default_factory=list)
    rows: int = 0
    by_region: dict[str, int] = field(default_factory=dict)
    raw_bytes: int | None = None

    def __post_init__(self):
        self.regions = list(dict.fromkeys(self.regions))
        if len(self.regions) > REGIONS:
            raise ValueError(f"a run names {REGIONS} regions at most")
        self._seen = Observation()

    def observe(self, df: DataFrame, raw: Column | None = None) -> DataFrame:
        """The same rows, counted as they pass."""
        counts = [F.count_if(F.col("region") == r).alias(f"n{k}") for k, r in enumerate(self.regions)]
        size = [F.coalesce(F.sum(raw), F.lit(0)).alias("raw")] if raw is not None else []
        return df.observe(self._seen, F.count("*").alias("n"), *counts, *size)

    def done(self) -> Written:
        got = self._seen.get
        self.rows, self.raw_bytes = got["n"], got.get("raw")
        self.by_region = {r: got[f"n{k}"] for k, r in enumerate(self.regions)}
        return self


def write_table(df: DataFrame, name: str, path: str, regions: list[str] | None = None) -> Written:
    """A table by region, in spatial order; only the regions in ``df`` are replaced.

    With ``regions``, those of the run, what earlier runs left for a region that has no rows now
    is removed, and a row of another region is an error. Tables that must change together are
    published instead (:mod:`roadspark.publication`).
    """
    ordered = spatial_order(checked(df, name)) if name != "metadata" else checked(df, name)
    written = Written(regions or [])
    written.observe(ordered).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("region").parquet(f"{path}/{name}")
    written.done()
    if regions is not None:
        if sum(written.by_region.values()) < written.rows:
            raise ValueError(f"{name} has rows of regions that the run does not name")
        for region in (r for r, n in written.by_region.items() if not n):
            remove(df.sparkSession, f"{path}/{name}/{partition_folder(df.sparkSession, 'region', region)}")
    return written


def write_tables(tables: dict[str, DataFrame], metadata: DataFrame, path: str, regions: list[str] | None = None) -> dict[str, Written]:
    """All tables, one after the other; metadata comes last and marks them complete."""
    found = {name: write_table(df, name, path, regions) for name, df in tables.items()}
    return found | {"metadata": write_table(metadata, "metadata", path, regions)}


def calming_items(df: DataFrame) -> DataFrame:
    return df.select("region", F.struct("lat", "lon", "type", "tags", F.col("end_lat").alias("endLat"), F.col("end_lon").alias("endLon"), F.col("way_id").alias("wayId")).alias("item"))


def core_bundles(calming: DataFrame, rounds: DataFrame, version: str, most: int = DOCUMENT_ITEMS) -> DataFrame:
    """region and ``value``: a region's core bundle as one JSON document, an export for small data.

    A document is one value, so a region of more than ``most`` items is an error; lines
    (:func:`write_core_lines`) have no such bound.
    """
    items = calming_items(calming).select("region", F.col("item").alias("c"), F.lit(None).cast("struct<lat:double,lon:double,radius:double,type:string>").alias("r"))
    items = items.unionByName(rounds.select("region", F.lit(None).cast(items.schema["c"].dataType).alias("c"), F.struct("lat", "lon", "radius", "type").alias("r")))
    largest = items.groupBy("region").count().agg(F.max("count")).first()[0] or 0
    if largest > most:
        raise ValueError(f"a core bundle of {largest} items is no single document; write lines")
    bundles = items.groupBy("region").agg(F.collect_list("c").alias("trafficCalming"), F.collect_list("r").alias("roundabouts"))
    return bundles.select("region", F.to_json(F.struct(F.lit(version).alias("version"), "region", "trafficCalming", "roundabouts")).alias("value"))


def write_core_bundles(calming: DataFrame, rounds: DataFrame, version: str, path: str) -> None:
    """Gzip documents, a folder for each region."""
    bundles = core_bundles(saved(calming, "calming"), saved(rounds, "rounds"), version)
    bundles.withColumnRenamed("region", "folder").repartition("folder").write.mode("overwrite").partitionBy("folder").option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)


def _write_json_lines(df: DataFrame, version: str, path: str, regions: list[str] | None) -> Written:
    line = F.to_json(F.struct("region", F.lit(version).alias("version"), *[c for c in df.columns if c != "region"]))
    written = Written(regions or [])
    lines = written.observe(df.select("region", line.alias("value")), F.octet_length("value") + 1)
    lines.write.mode("overwrite").partitionBy("region").option("compression", "gzip").text(path)
    return written.done()


def write_core_lines(calming: DataFrame, rounds: DataFrame, version: str, path: str, regions: list[str] | None = None, written: dict[str, Written] | None = None) -> tuple[str, str]:
    """The core bundle as gzip JSON lines, as many files as tasks, with version and region in
    each line. Returns the two folders.

    With ``regions``, those of the run, a header table beside the items names them all, those
    without any items too. ``written`` gets what the writes counted.
    """
    folders = f"{path}/trafficCalming", f"{path}/roundabouts"
    counts = [_write_json_lines(calming_items(calming).select("region", "item.*"), version, folders[0], regions), _write_json_lines(rounds.select("region", "lat", "lon", "radius", "type"), version, folders[1], regions)]
    if regions is not None:
        write_header(calming.sparkSession, regions, version, f"{path}/{HEADER}")
    if written is not None:
        written |= dict(zip(("traffic_calming", "roundabouts"), counts))
    return folders


def write_header(spark: SparkSession, regions: list[str], version: str, path: str) -> None:
    """The header table of a run in line form: a row for each of its regions. It comes last."""
    rows = spark.createDataFrame([(r, version) for r in Written(regions).regions], "region string, version string")
    rows.coalesce(1).write.mode("overwrite").json(path)


def write_lines(df: DataFrame, path: str, version: str = "", regions: list[str] | None = None) -> Written:
    """Road ways or surfaces as gzip JSON lines, a folder for each region."""
    return _write_json_lines(df.select("region", *[c for c in ("coords", "highway", "surface") if c in df.columns]), version, path, regions)


def write_document(document: DataFrame, path: str) -> None:
    """A one-row JSON document."""
    document.select("value").coalesce(1).write.mode("overwrite").text(path)


def write_metrics(spark: SparkSession, path: str, raw: dict[str, int] | None = None, seconds: float | None = None) -> DataFrame:
    """Files and bytes below a path, by its first folder: the sizes a run reports.

    With ``raw`` (bytes before compression, by folder, as the writes counted them) also how much
    smaller the files are, in percent; with ``seconds`` the time the run took. Files are listed,
    not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    folder = F.regexp_extract("path", re.escape(path.rstrip("/").rsplit("/", 1)[-1]) + r"/([^/]+)/", 1)
    found = files.groupBy(folder.alias("folder")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    known = F.element_at(F.create_map(*[F.lit(x) for k, v in raw.items() for x in (k, int(v))]), F.col("folder")) if raw else F.lit(None).cast("bigint")
    return found.select("folder", "files", "bytes", known.alias("raw_bytes"), F.when(known > 0, F.round((1 - F.col("bytes") / known) * 100, 1)).alias("smaller_percent"), F.lit(seconds).cast("double").alias("seconds"))


def json_bytes(df: DataFrame) -> int:
    """Bytes of the rows as JSON lines, before compression, where no write has counted them."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))) + 1), F.lit(0))).first()[0]
