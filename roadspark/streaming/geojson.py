"""Structured Streaming over GeoJSON text sequences: new files become rows of the tables.

Extraction works line by line, so the stream keeps no state and needs no watermark. Each batch
writes below a folder of its own number, replacing what an earlier attempt at the batch has
left, so a restart doubles nothing: ``<table>/batch=<n>/region=<region>/`` for each table,
``rejected/batch=<n>/`` for the lines that are no features, and at last ``counts/batch=<n>/``
with the batch's numbers of good, blank and rejected lines and of rows by table. A batch
without counts is not complete, and :func:`read_streamed` does not show it.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import features as x
from ..operators import filters as f
from ..operators.layout import checked
from ..sources.geojson import features, features_of_lines, line_counts, parse_lines
from ..storage import names, remove

SCHEMAS = {"traffic_calming": schemas.TRAFFIC_CALMING, "roundabouts": schemas.ROUNDABOUTS, "road_ways": schemas.ROAD_WAYS, "road_surfaces": schemas.ROAD_SURFACES}
COUNTS = "batch long, features long, blank long, rejected long, " + ", ".join(f"{t} long" for t in SCHEMAS)


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def stream_features(spark: SparkSession, path: str, region: str, files_per_trigger: int = 16) -> DataFrame:
    """The features of a folder's files, as they arrive."""
    return features_of_lines(stream_lines(spark, path, files_per_trigger), region)


def stream_road_ways(spark: SparkSession, source: str, region: str, target: str, checkpoint: str) -> StreamingQuery:
    """Append the road ways of arriving files to a Parquet table; ends when all are read."""
    rows = x.road_ways(stream_features(spark, source, region))
    return rows.writeStream.format("parquet").partitionBy("region").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)


def tables_of(found: DataFrame) -> dict[str, DataFrame]:
    """The four tables of features that come as GeoJSON: roads are the drivable ways."""
    calming, rounds = x.core(found)
    roads = found.where(f.drivable())
    return {"traffic_calming": calming, "roundabouts": rounds, "road_ways": x.road_ways(roads), "road_surfaces": x.road_surfaces(roads.where(f.has_surface()))}


def write_batch(lines: DataFrame, batch: int, region: str, target: str) -> None:
    """One batch of lines into all tables; again for the same number, it replaces them."""
    spark = lines.sparkSession
    remove(spark, f"{target}/counts/batch={batch}")  # until it is written again, the batch is not complete
    # Parsed once for all outputs; what an executor loses is parsed again from its files.
    parsed = parse_lines(lines).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        seen = parsed.agg(*line_counts()).first()
        parsed.where("rejected").select(F.col("line").alias("value")).write.mode("overwrite").text(f"{target}/rejected/batch={batch}")
        rows = {}
        for name, df in tables_of(features(parsed.where("not blank and not rejected"), region)).items():
            counted = Observation()
            checked(df, name).observe(counted, F.count("*").alias("n")).write.mode("overwrite").partitionBy("region").parquet(f"{target}/{name}/batch={batch}")
            rows[name] = counted.get["n"]
        row = (batch, seen.features, seen.blank, seen.rejected, *(rows[t] for t in SCHEMAS))
        spark.createDataFrame([row], COUNTS).drop("batch").coalesce(1).write.mode("overwrite").parquet(f"{target}/counts/batch={batch}")
    finally:
        parsed.unpersist()


def stream_tables(spark: SparkSession, source: str, region: str, target: str, checkpoint: str, files_per_trigger: int = 16) -> StreamingQuery:
    """All four tables of arriving files, rejected lines and counts; ends when all are read."""
    lines = stream_lines(spark, source, files_per_trigger)
    return lines.writeStream.foreachBatch(lambda df, n: write_batch(df, n, region, target)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def complete_batches(spark: SparkSession, target: str) -> list[int]:
    """The batches whose counts are written: those whose tables are all there."""
    return sorted(int(n[len("batch=") :]) for n in names(spark, f"{target}/counts") if n.startswith("batch=") and "_SUCCESS" in names(spark, f"{target}/counts/{n}"))


def read_streamed(spark: SparkSession, target: str, table: str) -> DataFrame:
    """A table's rows of all complete batches, with their ``batch``; or ``counts``, a row a batch."""
    whole = complete_batches(spark, target)
    schema = COUNTS if table == "counts" else f"{SCHEMAS[table]}, batch long"
    if not whole:
        return spark.createDataFrame([], schema)
    # Batches are numbered from 0 on without gaps, so a range says it in short.
    shown = F.col("batch").isin(*whole) if whole != list(range(len(whole))) else F.col("batch") < len(whole)
    return spark.read.schema(schema).parquet(f"{target}/{table}").where(shown)


def read_rejected(spark: SparkSession, target: str) -> DataFrame:
    """batch, value: the lines of complete batches that were no features."""
    whole = complete_batches(spark, target)
    if not whole:
        return spark.createDataFrame([], "value string, batch long")
    return spark.read.schema("value string, batch long").text(f"{target}/rejected").where(F.col("batch").isin(*whole))
