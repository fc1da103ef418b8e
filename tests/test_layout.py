"""Layout: Z-order keys, files and row groups that a box does not touch, tables stored by node."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from roadspark import fixtures as fx
from roadspark import sinks
from roadspark.operators import features as x
from roadspark.operators import layout
from roadspark.operators.geometry import assemble_geometry, open_by_node, stored_by_node
from roadspark.plans import extract

SF = "/root/testdata/sf0.001"


def interleaved(lat, lon):
    scaled = lambda v, least, most: int((max(least, min(most, v)) - least) / (most - least) * (2**31 - 1))
    p, q = scaled(lat, -90, 90), scaled(lon, -180, 180)
    return sum(((p >> k) & 1) << (2 * k) | ((q >> k) & 1) << (2 * k + 1) for k in range(31))


def test_keys(spark):
    places = [(1.5, 2.5), (-90.0, -180.0), (90.0, 180.0), (100.0, -500.0), (51.477, -0.001), (51.477, 0.001)]
    df = spark.createDataFrame([*places, (None, 1.0), (float("nan"), 1.0)], "lat double, lon double")
    got = df.select("lat", "lon", layout.z_order(F.col("lat"), F.col("lon")).alias("z")).collect()
    assert [r.z for r in got] == [*(interleaved(*p) for p in places), None, None]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Points over half the world, most of them in one small place."""
    path = str(tmp_path_factory.mktemp("layout"))
    spread = spark.range(20000).select(F.lit("r").alias("region"), (F.rand(1) * 120 - 60).alias("lat"), (F.rand(2) * 300 - 150).alias("lon"))
    dense = spark.range(60000).select(F.lit("r").alias("region"), (50 + F.rand(3) / 10).alias("lat"), (8 + F.rand(4) / 10).alias("lon"))
    rows = spread.unionByName(dense).select("region", "lat", "lon", F.lit(3.0).alias("radius"), F.lit("roundabout").alias("type"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        sinks.write_table(rows, "roundabouts", path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    layout.write_file_bounds(spark, f"{path}/roundabouts")
    return f"{path}/roundabouts"


BOXES = [(50.02, 50.04, 8.02, 8.04), (-10.0, 0.0, 20.0, 30.0), (70.0, 80.0, 0.0, 1.0), (-90.0, 90.0, -180.0, 180.0)]


@pytest.mark.parametrize("box", BOXES)
def test_a_box_has_all_its_rows(spark, stored, box):
    every = spark.read.parquet(stored)
    low, high, west, east = box
    expected = every.where(f"lat between {low} and {high} and lon between {west} and {east}")
    key = lambda df: sorted((r.lat, r.lon) for r in df.collect())
    assert key(layout.read_box(spark, stored, *box)) == key(expected) == key(layout.bbox_query(every, *box))


def test_most_files_and_row_groups_are_never_read(spark, stored):
    files = glob.glob(f"{stored}/region=r/*.parquet")
    assert len(files) >= 40
    for low, high, west, east in BOXES[:2]:
        named = layout.files_of_box(spark, stored, low, high, west, east)
        groups = [pq.ParquetFile(f).metadata.row_group(0) for f in files]
        bounds = [{c.path_in_schema: (c.statistics.min, c.statistics.max) for c in (g.column(k) for k in range(g.num_columns)) if c.path_in_schema in ("lat", "lon")} for g in groups]
        touched = [b for b in bounds if b["lat"][1] >= low and b["lat"][0] <= high and b["lon"][1] >= west and b["lon"][0] <= east]
        assert len(named) == len(touched) <= len(files) // 3
        read = layout.read_box(spark, stored, low, high, west, east)
        assert set(read.inputFiles()) <= {"file://" + f for f in files} and len(read.inputFiles()) == len(named)
    assert layout.files_of_box(spark, stored, *BOXES[2]) == [] and layout.read_box(spark, stored, *BOXES[2]).count() == 0


def test_dense_places_get_files_of_their_own(spark, stored):
    sizes = [r.rows for r in spark.read.parquet(f"{stored}_files").collect()]
    assert max(sizes) < 2.5 * sum(sizes) / len(sizes)


def test_too_many_files_or_odd_names_read_the_table(spark, stored, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "NAMED_FILES", 1)
    assert layout.files_of_box(spark, stored, *BOXES[3]) is None
    assert layout.read_box(spark, stored, *BOXES[0]).count() == layout.bbox_query(spark.read.parquet(stored), *BOXES[0]).count()
    odd = spark.createDataFrame([("a b{c}", 1.0, 1.0, 3.0, "roundabout"), ("ü%", 1.0, 1.0, 3.0, "roundabout")], "region string, lat double, lon double, radius double, type string")
    sinks.write_table(odd, "roundabouts", str(tmp_path))
    layout.write_file_bounds(spark, f"{tmp_path}/roundabouts")
    monkeypatch.undo()
    assert sorted(r.region for r in layout.read_box(spark, f"{tmp_path}/roundabouts", 0, 2, 0, 2).collect()) == ["a b{c}", "ü%"]


def test_stored_by_node(spark):
    """The same features, and no exchange of nodes or references before the places are known."""
    ways, nodes, refs = fx.ways(spark, SF), fx.nodes(spark, SF), fx.way_nodes(spark, SF)
    key = {"node_key": ("node_id",)}
    by_nodes, by_refs = stored_by_node(nodes, refs, 8, **key)
    rows = lambda df: sorted(map(repr, df.select(sorted(df.columns)).collect()))
    expected = rows(x.road_ways(extract.road_features(ways, nodes, refs, **key)))
    assert rows(x.road_ways(extract.road_features(ways, by_nodes, by_refs, by_node=True, **key))) == expected
    for threshold in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            plan = assemble_geometry(ways, by_nodes, by_refs, by_node=True, **key)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "hashpartitioning(node_id" not in plan and "Bucketed: true" in plan
    plain = assemble_geometry(ways, nodes, refs, **key)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "hashpartitioning(node_id" in assemble_geometry(ways, nodes, refs, **key)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Another session knows the table by its folder.
    path = by_refs.select("_metadata.file_path").first()[0].removeprefix("file:").rsplit("/", 1)[0]
    again = open_by_node(spark, path, "refs_again", "way_id bigint, node_id bigint, seq bigint", 8, ("node_id",))
    assert again.count() == refs.count()
    assert rows(x.road_ways(extract.road_features(ways, by_nodes, again, by_node=True, **key))) == expected
    assert plain.count() > 0
