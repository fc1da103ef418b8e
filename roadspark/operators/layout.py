"""Operators on finished tables: bounding boxes, duplicates, spatial order, checks."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import REQUIRED
from ..storage import scratch_path


def bbox_query(df: DataFrame, min_lat: float, max_lat: float, min_lon: float, max_lon: float) -> DataFrame:
    """Rows whose bounds, or place, overlap a box. Plain ranges, so Parquet statistics prune."""
    low_lat, high_lat, low_lon, high_lon = bound_columns(df)
    return df.where((F.col(high_lat) >= min_lat) & (F.col(low_lat) <= max_lat) & (F.col(high_lon) >= min_lon) & (F.col(low_lon) <= max_lon))


def dedup_segments(df: DataFrame) -> DataFrame:
    """One row for each way of a region, the first by place and type; rows without a way id stay."""
    order = F.struct("lat", "lon", "type", "end_lat", "end_lon")
    ways = df.where("way_id is not null").groupBy("region", "way_id").agg(F.min_by(F.struct(*df.columns), order).alias("row")).select("row.*")
    return ways.unionByName(df.where("way_id is null"))


def _spread(value: Column) -> Column:
    """The low 32 bits of a number, moved to every second place: four at a time."""
    moved = F.array(*[F.lit(sum(((n >> k) & 1) << (2 * k) for k in range(4))).cast("bigint") for n in range(16)])
    part = lambda k: F.shiftleft(F.get(moved, F.shiftright(value, 4 * k).bitwiseAND(F.lit(15)).cast("int")), 8 * k)
    return reduce(Column.bitwiseOR, [part(k) for k in range(8)])


def z_order(lat: Column, lon: Column) -> Column:
    """The bits of latitude and longitude, 31 each, interleaved: places that are near each other
    mostly have near keys, at whatever scale. What is beyond the poles or the date line counts as
    there; a null or NaN has no key."""

    def scaled(value: Column, least: float, most: float) -> Column:
        share = (F.greatest(F.lit(least), F.least(F.lit(most), value)) - least) / (most - least)
        return F.when(value.isNotNull() & ~F.isnan(value), F.floor(share * (2**31 - 1)))

    return _spread(scaled(lat, -90.0, 90.0)).bitwiseOR(F.shiftleft(_spread(scaled(lon, -180.0, 180.0)), 1))


def bound_columns(df: DataFrame) -> tuple[str, str, str, str]:
    """The columns of lowest and highest latitude and longitude: bounds, or a place's own."""
    return ("min_lat", "max_lat", "min_lon", "max_lon") if "min_lat" in df.columns else ("lat", "lat", "lon", "lon")


def spatial_order(df: DataFrame) -> DataFrame:
    """Rows dealt and sorted by region and by Z-order of their middle, for narrow Parquet statistics.

    The ranges are cut where the rows are, so dense places get files of their own and no cell
    size has to be chosen; a busy region is cut into as many ranges as it needs.
    """
    low_lat, high_lat, low_lon, high_lon = bound_columns(df)
    key = z_order((F.col(low_lat) + F.col(high_lat)) / 2, (F.col(low_lon) + F.col(high_lon)) / 2)
    order = _free(df, "order")  # computed once, and carried through the exchange
    return df.withColumn(order, key).repartitionByRange("region", order).sortWithinPartitions("region", order).drop(order)


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


#: Files that are named one by one; a box that touches more reads the whole table with a filter.
NAMED_FILES = 10_000


def write_file_bounds(spark: SparkSession, path: str) -> None:
    """Beside a table, in ``<path>_files``: each of its files with its rows and bounds."""
    df = spark.read.parquet(path)
    low_lat, high_lat, low_lon, high_lon = bound_columns(df)
    rows = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"), F.min(low_lat).alias("min_lat"), F.max(high_lat).alias("max_lat"), F.min(low_lon).alias("min_lon"), F.max(high_lon).alias("max_lon"))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}_files")


def files_of_box(spark: SparkSession, path: str, min_lat: float, max_lat: float, min_lon: float, max_lon: float) -> list[str] | None:
    """The files of a table whose bounds overlap a box; None if they are more than NAMED_FILES,
    or have names that Spark would take for patterns."""
    found = bbox_query(spark.read.parquet(f"{path}_files"), min_lat, max_lat, min_lon, max_lon).select("file").limit(NAMED_FILES + 1).collect()
    files = sorted(unquote(r.file) for r in found)  # the column holds URIs
    return files if len(files) <= NAMED_FILES and not any(set(f) & set("[]{}*?") for f in files) else None


def read_box(spark: SparkSession, path: str, min_lat: float, max_lat: float, min_lon: float, max_lon: float) -> DataFrame:
    """The rows of a table that overlap a box, from the files alone that can have some.

    The table's file bounds (:func:`write_file_bounds`) must be those of its present files.
    """
    files = files_of_box(spark, path, min_lat, max_lat, min_lon, max_lon)
    whole = spark.read.parquet(path)
    some = whole if files is None else spark.read.schema(whole.schema).option("basePath", path).parquet(*files) if files else whole.limit(0)
    return bbox_query(some.select(whole.columns), min_lat, max_lat, min_lon, max_lon)


def checked(df: DataFrame, table: str) -> DataFrame:
    """The same rows; reading a row that lacks a required value is an error."""
    out = df
    for column in REQUIRED[table]:
        message = F.lit(f"{table}.{column} must not be null")
        kind = dict(df.dtypes)[column]
        out = out.withColumn(column, F.coalesce(F.col(column), F.raise_error(message).cast(kind)))
    return out


def with_ids(df: DataFrame, *order: str) -> DataFrame:
    """Rows with a running ``id`` from 1 in the given order, for an export.

    Sorted ranges are written once; a range's first id is the count of rows before it, a
    prefix sum over one row for each range.
    """
    path = scratch_path(df.sparkSession, "ids")
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The low 33 bits of the increasing id are the row's place in its range.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranges.withColumns({"range_": F.spark_partition_id(), "place_": place}).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    # A row for each range; whether they are broadcast is left to their measured size.
    sizes = rows.groupBy("range_").agg(F.count("*").alias("n_"))
    before = sizes.select("range_", (F.sum("n_").over(Window.orderBy("range_")) - F.col("n_")).alias("before_"))
    return rows.join(before, "range_").select((F.col("before_") + F.col("place_") + 1).alias("id"), *df.columns)
