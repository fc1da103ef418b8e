"""Bundles of a region's features, with version and region.

A bundle is either a JSON document that holds arrays of items, or a folder of JSON lines with
an item, its version and its region each. Both are read alike, and strictly: a line or a
document that is cut or is no JSON, or whose values have other types, is an error of the job
that reads it, never a row less. Which of the two forms a folder has is told by its first
line: one that is no JSON object by itself belongs to a document over several lines, and then
every file of the folder is one document.

In line form a header table (:data:`HEADER` in the bundle's folder, one row a region) says which
regions a run has written and in what version, whether or not a region has any items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import exists

CALMING_ITEM = "struct<lat:double, lon:double, type:string, endLat:double, endLon:double, wayId:bigint, tags:map<string,string>>"
ROUNDABOUT_ITEM = "struct<lat:double, lon:double, radius:double, type:string>"
WAY_ITEM = "struct<coords:array<double>, highway:string, surface:string>"
SURFACE_ITEM = "struct<coords:array<double>, surface:string>"
ARRAYS = {"trafficCalming": CALMING_ITEM, "roundabouts": ROUNDABOUT_ITEM, "roadWays": WAY_ITEM, "roadSurfaces": SURFACE_ITEM}
#: The folder, beside the items of a core bundle in line form, that holds the header table.
HEADER = "header"
#: Regions of one run, at most: a row each may come to the driver.
REGIONS = 1024

#: A field that every item has, whatever its array.
_SURE = {"trafficCalming": "lat", "roundabouts": "lat", "roadWays": "coords", "roadSurfaces": "coords"}


def _rows(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """One row for each line, or for each file where a document spans several lines."""
    first = spark.read.text(path).where("trim(value) <> ''").select(F.try_parse_json("value").isNotNull().alias("whole")).first()
    documents = first is not None and not first.whole
    return spark.read.schema(f"version string, region string{fields}").option("mode", "FAILFAST").option("multiLine", documents).json(path)


def read_header(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """version and region of each bundle, once; a missing one is empty.

    ``header`` names the header table of a run in line form; without one the bundles
    themselves are read.
    """
    rows = _rows(spark, header or path, "")
    return rows.select(F.coalesce("version", F.lit("")).alias("version"), F.coalesce("region", F.lit("")).alias("region")).distinct()


def versions(header: DataFrame) -> dict[str, str]:
    """The version of each region; an error if a region has two."""
    rows = header.limit(REGIONS + 1).collect()
    if len(rows) > REGIONS:
        raise ValueError(f"more than {REGIONS} regions in one run")
    found = {r.region: r.version for r in rows}
    if len(found) < len(rows):
        raise ValueError("a region has core bundles of several versions")
    return found


def _checked_version(expected: dict[str, str]) -> Column:
    """True for rows of the expected version; reading any other row is an error."""
    region, version = (F.coalesce(c, F.lit("")) for c in ("region", "version"))
    known = F.create_map(*[F.lit(x) for pair in expected.items() for x in pair])[region] if expected else F.lit(None).cast("string")
    said = F.concat(F.lit("items of "), region, F.lit(" have version '"), version, F.lit("', its core has "), F.coalesce(F.concat(F.lit("'"), known, F.lit("'")), F.lit("none")))
    return F.when(F.coalesce(version == known, F.lit(False)), True).otherwise(F.raise_error(said).cast("boolean"))


def read_items(spark: SparkSession, path: str, array: str, expected: dict[str, str] | None = None) -> DataFrame:
    """One row for each item of an array of the bundles, with the bundle's region.

    Files that hold neither such an array nor such items, but something else, are an error;
    a document may lack the array if another one has it. With ``expected`` (the version of each
    region's core) rows of another version, or of a region without a core, are an error too.
    """
    item = ARRAYS[array]
    rows = _rows(spark, path, f", {array} array<{item}>, {item[len('struct<') : -1].replace(':', ' ')}")
    known = F.col(array).isNotNull() | F.col(_SURE[array]).isNotNull()
    if rows.limit(1).count() and not rows.where(known).limit(1).count() and not _holds_other_arrays(spark, path):
        raise ValueError(f"{path} holds no {array}")
    if expected is not None:
        rows = rows.where(_checked_version(expected))
    names = spark.createDataFrame([], f"item {item}").select("item.*").columns
    items = F.coalesce(array, F.when(F.col(_SURE[array]).isNotNull(), F.array(F.struct(*names).cast(item))))
    return rows.select("region", F.explode(items).alias("item")).select("region", "item.*")


def _holds_other_arrays(spark: SparkSession, path: str) -> bool:
    fields = "".join(f", {a} array<{kind}>" for a, kind in ARRAYS.items())
    return _rows(spark, path, fields).where(F.coalesce(*[F.size(a) for a in ARRAYS]).isNotNull()).limit(1).count() > 0


def read_optional(spark: SparkSession, path: str, array: str, required: bool = False, expected: dict[str, str] | None = None) -> DataFrame:
    """Items of a bundle that may be absent: then no rows, or an error if it is required."""
    if exists(spark, path):
        return read_items(spark, path, array, expected)
    if required:
        raise FileNotFoundError(path)
    return spark.createDataFrame([], f"region string, item {ARRAYS[array]}").select("region", "item.*")
