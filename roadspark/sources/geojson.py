"""GeoJSON sources: text sequences (a feature a line) and FeatureCollection documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.tags import trimmed
from ..vocabulary import TAGS

#: ``coordinates`` stays JSON text: its depth depends on the geometry's type.
FEATURE = "struct<type:string, id:string, properties:map<string,string>, geometry:struct<type:string, coordinates:string>>"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _points(coordinates: Column, geom_type: Column) -> Column:
    """The vertices of points, lines and outer rings; the first two values of each are lon, lat."""

    def pairs(nested: Column) -> Column:
        return F.transform(nested, lambda c: F.struct(F.get(c, F.lit(0)).alias("lon"), F.get(c, F.lit(1)).alias("lat")))

    return (
        F.when(geom_type == "Point", pairs(F.array(F.from_json(coordinates, "array<double>"))))
        .when(geom_type == "LineString", pairs(F.from_json(coordinates, "array<array<double>>")))
        .when(geom_type == "Polygon", pairs(F.get(F.from_json(coordinates, "array<array<array<double>>>"), F.lit(0))))
    )


def features(rows: DataFrame, region: str) -> DataFrame:
    """The common feature columns, of rows with the column ``f``."""
    tags = F.struct(*[F.col("f.properties")[t].alias(t) for t in TAGS])
    return rows.select(
        F.lit(region).alias("region"),
        F.col("f.id").alias("id"),
        F.col("f.geometry.type").alias("geom_type"),
        tags.alias("tags"),
        _points(F.col("f.geometry.coordinates"), F.col("f.geometry.type")).alias("pts"),
    )


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Each ``line``, its feature ``f``, and whether it is ``blank`` or ``rejected``.

    A line is trimmed and may begin with a record separator. Blank lines are skipped; lines
    that are not one JSON object, or lack geometry or properties, are rejected.
    """
    text = F.regexp_replace(trimmed(F.col(column)), "^\\x1e", "")
    schema = FEATURE[len("struct<") : -1] + ", corrupt:string"
    rows = lines.select(text.alias("line")).withColumn("f", F.from_json("line", f"struct<{schema}>", _OPTIONS))
    bad = F.col("f.corrupt").isNotNull() | ~F.col("line").endswith("}") | F.col("f.geometry").isNull() | F.col("f.properties").isNull()
    return rows.select("line", F.col("f"), (F.col("line") == "").alias("blank"), ((F.col("line") != "") & F.coalesce(bad, F.lit(True))).alias("rejected"))


def features_of_lines(lines: DataFrame, region: str, column: str = "value", counts: Observation | None = None) -> DataFrame:
    """Features of the good lines. ``counts`` gets features, blank and rejected from the same pass."""
    parsed = parse_lines(lines, column)
    if counts is not None:
        parsed = parsed.observe(counts, *line_counts())
    return features(parsed.where("not blank and not rejected"), region)


def read_sequence(spark: SparkSession, path: str, region: str, counts: Observation | None = None) -> DataFrame:
    """Features of GeoJSON text-sequence files."""
    return features_of_lines(spark.read.text(path), region, counts=counts)


def line_counts() -> list[Column]:
    return [F.count_if(~F.col("blank") & ~F.col("rejected")).alias("features"), F.count_if("blank").alias("blank"), F.count_if("rejected").alias("rejected")]


def count_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row: features, blank and rejected lines."""
    return parse_lines(lines, column).agg(*line_counts())


def read_collection(spark: SparkSession, path: str, region: str) -> DataFrame:
    """Features of FeatureCollection documents; a broken document is an error.

    A document is read by one task; prefer text sequences for large data.
    """
    documents = spark.read.schema(f"type string, features array<{FEATURE}>").option("multiLine", True).option("mode", "FAILFAST").json(path)
    rows = documents.select(F.explode("features").alias("f")).where("f.geometry is not null and f.properties is not null")
    return features(rows, region)
