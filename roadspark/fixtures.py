"""OSM-shaped tables derived from the driver's tables (FIXTURES.md, part B), as Spark SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import tag_struct

NODES = """
SELECT p_partkey AS node_id,
 CASE p_partkey%5 WHEN 0 THEN 'AFRICA' WHEN 1 THEN 'AMERICA' WHEN 2 THEN 'ASIA' WHEN 3 THEN 'EUROPE' ELSE 'MIDDLE EAST' END AS region,
 50 + CAST((p_partkey*37)%2000 AS DOUBLE)/10000 AS lat,
 -1 + CAST((p_partkey*91)%3000 AS DOUBLE)/10000 AS lon,
 CASE p_partkey%16 WHEN 0 THEN 'bump' WHEN 1 THEN 'hump;table' WHEN 2 THEN ' chicane ; choker ' WHEN 3 THEN 'dip' WHEN 4 THEN 'island'
  WHEN 5 THEN 'rumble_strip' WHEN 6 THEN 'double_dip;;cushion' WHEN 7 THEN '' WHEN 8 THEN 'Bump' END AS traffic_calming,
 CASE p_partkey%23 WHEN 0 THEN 'speed_camera' WHEN 1 THEN 'mini_roundabout' WHEN 2 THEN 'crossing' END AS highway,
 CASE WHEN p_partkey%29=0 THEN 'maxspeed' END AS enforcement,
 p_name AS name,
 CASE WHEN p_size%2=0 THEN CAST(p_size AS VARCHAR(9)) WHEN p_size%3=0 THEN '' END AS maxspeed
FROM {part}
"""
WAYS = """
SELECT o.o_orderkey AS way_id, r.r_name AS region,
 CASE o.o_orderkey%4 WHEN 0 THEN concat('way/', CAST(o.o_orderkey AS VARCHAR(20))) ELSE concat('w', CAST(o.o_orderkey AS VARCHAR(20))) END AS id,
 CASE o.o_orderkey%19 WHEN 0 THEN 'motorway' WHEN 1 THEN 'footway' WHEN 2 THEN 'service' WHEN 3 THEN 'service' WHEN 4 THEN 'track' WHEN 5 THEN 'cycleway'
  WHEN 7 THEN '' WHEN 8 THEN 'primary_link' WHEN 9 THEN 'living_street' WHEN 6 THEN NULL ELSE 'residential' END AS highway,
 CASE o.o_orderkey%3 WHEN 0 THEN 'driveway' WHEN 1 THEN 'parking_aisle' END AS service,
 CASE o.o_custkey%26 WHEN 0 THEN 'asphalt' WHEN 1 THEN 'concrete' WHEN 2 THEN 'concrete:plates' WHEN 3 THEN 'concrete:lanes' WHEN 4 THEN 'paved'
  WHEN 5 THEN 'cobblestone' WHEN 6 THEN 'cobblestone:flattened' WHEN 7 THEN 'paving_stones' WHEN 8 THEN 'sett' WHEN 9 THEN 'gravel' WHEN 10 THEN 'fine_gravel'
  WHEN 11 THEN 'pebblestone' WHEN 12 THEN 'compacted' WHEN 13 THEN 'dirt' WHEN 14 THEN 'earth' WHEN 15 THEN 'mud' WHEN 16 THEN 'sand' WHEN 17 THEN 'grass'
  WHEN 18 THEN 'grass_paver' WHEN 19 THEN 'unpaved' WHEN 20 THEN 'ground' WHEN 21 THEN 'Asphalt' WHEN 22 THEN 'metal' WHEN 23 THEN '' END AS surface,
 CASE WHEN o.o_orderkey%11=0 THEN 'roundabout' END AS junction,
 CASE o.o_orderkey%13 WHEN 0 THEN 'yes' WHEN 1 THEN 'viaduct' END AS bridge,
 CASE WHEN o.o_orderkey%17=0 THEN 'yes' END AS tunnel,
 CASE WHEN o.o_orderkey%14=0 THEN 'yes' END AS area,
 CASE WHEN o.o_orderkey%5=0 THEN concat('A', CAST(o.o_custkey AS VARCHAR(20))) END AS ref,
 o.o_orderkey%7=0 AS closed
FROM {orders} o JOIN {customer} c ON o.o_custkey=c.c_custkey
 JOIN {nation} n ON c.c_nationkey=n.n_nationkey JOIN {region} r ON n.n_regionkey=r.r_regionkey
"""
OPEN_WAY_NODES = """
SELECT l_orderkey AS way_id, l_partkey AS node_id,
 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS seq
FROM {lineitem}
"""
WAY_NODES = """
SELECT way_id, node_id, CAST(seq AS BIGINT) AS seq FROM {open_way_nodes}
UNION ALL
SELECT f.way_id, f.node_id, CAST(k.n + 1 AS BIGINT) AS seq
FROM {open_way_nodes} f
JOIN (SELECT way_id, count(*) AS n FROM {open_way_nodes} GROUP BY way_id) k ON k.way_id=f.way_id
JOIN {ways} w ON w.way_id=f.way_id
WHERE f.seq=1 AND w.closed AND k.n>=3
"""
REGION_CATALOGUE = """
SELECT lower(n_name) AS id, CASE WHEN n_nationkey%7=0 THEN '' WHEN n_nationkey%5=4 THEN NULL ELSE n_name END AS name,
 r_name AS continent, CAST(n_nationkey AS DOUBLE) AS b0, CAST(n_nationkey+1 AS DOUBLE) AS b1,
 CAST(n_nationkey+2 AS DOUBLE) AS b2, CAST(n_nationkey+3 AS DOUBLE) AS b3,
 concat(lower(r_name), '/', lower(n_name), '-latest.osm.pbf') AS source_path, CAST(n_nationkey*10 AS BIGINT) AS estimated_size
FROM {nation} JOIN {region} ON n_regionkey=r_regionkey
"""
ARTIFACTS = """
SELECT concat(lower(n_name), '.json.gz') AS file, CAST(1000+n_nationkey AS BIGINT) AS size, concat('core', n_name) AS content FROM {nation} WHERE n_nationkey%6<>5
UNION ALL SELECT concat(lower(n_name), '-surfaces.json.gz'), CAST(2000+n_nationkey AS BIGINT), concat('surf', n_name) FROM {nation} WHERE n_nationkey%2=0
UNION ALL SELECT concat(lower(n_name), '-ways.json.gz'), CAST(3000+n_nationkey AS BIGINT), concat('way', n_name) FROM {nation} WHERE n_nationkey%3=0
UNION ALL SELECT concat(lower(n_name), '.sqlite.gz'), CAST(4000+n_nationkey AS BIGINT), concat('db', n_name) FROM {nation} WHERE n_nationkey%4<>0
UNION ALL SELECT concat(lower(n_name), '-ways-old.json.gz'), CAST(9 AS BIGINT), 'x' FROM {nation} WHERE n_nationkey=3
UNION ALL SELECT 'readme.txt', CAST(9 AS BIGINT), 'x' FROM {nation} WHERE n_nationkey=0
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_tags(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, tag_struct(df).alias("tags"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_tags(spark.sql(NODES, part=_table(spark, sf_dir, "part")), "region", "node_id", "lat", "lon")


def _ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(WAYS, **{t: _table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region")})


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_tags(_ways(spark, sf_dir), "region", "way_id", "id")


def way_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The references in order. An order key decides alone whether a way is closed, so the
    closing row needs no join: it is the first row once more, numbered by the way's count."""
    refs = spark.sql(
        "SELECT l_orderkey AS way_id, l_partkey AS node_id, row_number() OVER w AS seq, count(*) OVER (PARTITION BY l_orderkey) AS n FROM {lineitem} WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)",
        lineitem=_table(spark, sf_dir, "lineitem"),
    )
    closes = (F.col("seq") == 1) & (F.col("way_id") % 7 == 0) & (F.col("n") >= 3)
    own, again = F.col("seq").cast("bigint"), (F.col("n") + 1).cast("bigint")
    return refs.select("way_id", "node_id", F.explode(F.when(closes, F.array(own, again)).otherwise(F.array(own))).alias("seq"))


def region_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.sql(REGION_CATALOGUE, nation=_table(spark, sf_dir, "nation"), region=_table(spark, sf_dir, "region"))
    return df.select("id", "name", "continent", F.array("b0", "b1", "b2", "b3").alias("bbox"), "source_path", F.col("estimated_size").alias("estimatedSize"))


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.sql(ARTIFACTS, nation=_table(spark, sf_dir, "nation"))
    return df.select("file", "size", F.encode("content", "UTF-8").alias("content"))
