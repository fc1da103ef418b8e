"""From nodes, ways and their references to features with geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import scratch_path


def references(ways: DataFrame, way_nodes: DataFrame | None, *more: str) -> DataFrame:
    """way key, seq, node_id: from a reference table (with ``more`` of its columns), or from the
    array column ``nds`` of ways."""
    keys = [c for c in ("region", "way_id") if c in ways.columns]
    if way_nodes is None:
        return ways.select(*keys, F.posexplode("nds").alias("seq", "node_id"))
    on = [c for c in keys if c in way_nodes.columns]
    # Only the ways asked for: their key goes along, so the join also filters. A semi join would be
    # moved below a join that has already placed the nodes.
    return way_nodes.join(ways.select(*keys), on, "left_semi" if on == keys and not more else "inner").select(*keys, "seq", "node_id", *more)


def referenced_nodes(nodes: DataFrame, ways: DataFrame, way_nodes: DataFrame | None = None, node_key: tuple[str, ...] = ("region", "node_id")) -> DataFrame:
    """The nodes that the ways refer to, each once."""
    return nodes.join(references(ways, way_nodes), list(node_key), "left_semi")


def stored_by_node(nodes: DataFrame, way_nodes: DataFrame, buckets: int, node_key: tuple[str, ...] = ("region", "node_id")) -> tuple[DataFrame, DataFrame]:
    """Both tables stored in the shared folder in buckets of the node key, sorted by it.

    Joins of the two by that key, however many and whatever ways they are for, then need no
    exchange and no sort: the one large shuffle is paid for once. Use as many buckets as the
    session has shuffle partitions, or more; else Spark deals both sides anew. The tables are
    known to the session by name; :func:`open_by_node` makes them known to another.
    """
    return tuple(_bucketed(df, name, buckets, node_key) for df, name in ((nodes, "nodes"), (way_nodes, "way_nodes")))


def _bucketed(df: DataFrame, name: str, buckets: int, keys: tuple[str, ...]) -> DataFrame:
    spark, path = df.sparkSession, scratch_path(df.sparkSession, f"{name}-by-node")
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    # Dealt by the key first, so that a task writes whole buckets and no bucket has many files.
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


def open_by_node(spark: SparkSession, path: str, table: str, schema: str, buckets: int, node_key: tuple[str, ...] = ("region", "node_id")) -> DataFrame:
    """A table that :func:`stored_by_node` has left at a path, in another session. ``schema`` is
    written as in ``create table``."""
    keys = ", ".join(node_key)
    spark.sql(f"create table if not exists {table} ({schema}) using parquet clustered by ({keys}) sorted by ({keys}) into {buckets} buckets location '{path}'")
    return spark.table(table)


def assemble_geometry(ways: DataFrame, nodes: DataFrame, way_nodes: DataFrame | None = None, node_key: tuple[str, ...] = ("region", "node_id"), closed: str = "linestring", by_node: bool = False) -> DataFrame:
    """Features of ways: all columns of ``ways``, geom_type, pts, n_points, bounds and vertex means.

    Filter the ways first: this is the large join. References to missing nodes are dropped. A
    closed way (four vertices or more, first node = last) is a Polygon if its tag area is yes;
    other closed ways are by ``closed`` a linestring, a polygon, or both.
    ``node_key`` is ("node_id",) when one node table serves all regions. With ``by_node`` nodes
    and references come from :func:`stored_by_node`: they are joined where they lie, and only
    the places go on to their ways.
    """
    # A region that neither references nor nodes have stays with the ways. The number comes first:
    # sorts by it compare numbers, and strings only where those are equal.
    first = [c for c in ("region", "way_id") if c in ways.columns]
    keys = [c for c in first[::-1] if by_node or way_nodes is None or c in (*way_nodes.columns, *node_key)]
    wanted = ways.drop(*set(first) - set(keys))
    placed = nodes.select(*node_key, "lat", "lon")
    if by_node and way_nodes is not None:
        places = references(wanted, way_nodes.join(placed, list(node_key)), "lat", "lon")
    else:
        places = references(wanted, way_nodes).join(placed, list(node_key))
    # Dealt by way first: places that lie by node are of different ways, and to collect them there
    # would only make lists of one.
    shape = places.repartition(*keys).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("seq", "lon", "lat", "node_id"))).alias("v"),
        F.min("lat").alias("min_lat"),
        F.max("lat").alias("max_lat"),
        F.min("lon").alias("min_lon"),
        F.max("lon").alias("max_lon"),
        F.avg("lat").alias("mean_lat"),
        F.avg("lon").alias("mean_lon"),
    )
    ring = (F.size("v") >= 4) & (F.element_at("v", 1)["node_id"] == F.element_at("v", -1)["node_id"])
    area = F.coalesce(F.col("tags.area") == "yes", F.lit(False))
    kind = {
        "linestring": F.when(ring & area, F.array(F.lit("Polygon"))).otherwise(F.array(F.lit("LineString"))),
        "polygon": F.when(ring, F.array(F.lit("Polygon"))).otherwise(F.array(F.lit("LineString"))),
        "both": F.when(ring & area, F.array(F.lit("Polygon"))).when(ring, F.array(F.lit("LineString"), F.lit("Polygon"))).otherwise(F.array(F.lit("LineString"))),
    }[closed]
    joined = ways.drop("nds").join(shape, keys).where(F.size("v") >= 2)
    joined = joined.select(*first, *[c for c in (*ways.columns, *shape.columns) if c not in (*first, "nds")])
    return joined.withColumns({"pts": F.transform("v", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))), "n_points": F.size("v"), "geom_type": F.explode(kind)}).drop("v")


def point_features(nodes: DataFrame) -> DataFrame:
    """Features of nodes, with ids like ``n12``."""
    return nodes.select("region", F.concat(F.lit("n"), F.col("node_id")).alias("id"), F.lit("Point").alias("geom_type"), "tags", F.array(F.struct("lon", "lat")).alias("pts"))


def way_feature_id(ways: DataFrame) -> DataFrame:
    """Ways with their id as text, like ``w12``."""
    return ways.withColumn("id", F.concat(F.lit("w"), F.col("way_id")))
