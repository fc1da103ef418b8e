"""Sources, sinks, layout and streaming: what is written reads back."""

import json

import pytest
from pyspark.sql import functions as F

from roadspark import fixtures as fx
from roadspark import sinks
from roadspark.operators import features as x
from roadspark.operators import filters as f
from roadspark.operators.geometry import assemble_geometry
from roadspark.operators.layout import bbox_query, checked, dedup_segments, with_ids
from roadspark.plans import extract, manifest
from roadspark.sources import bundles, catalogue, geojson
from roadspark.streaming.geojson import stream_road_ways

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def elements(spark):
    return fx.ways(spark, SF), fx.nodes(spark, SF), fx.way_nodes(spark, SF)


@pytest.fixture(scope="module")
def tables(elements):
    return extract.extract(*elements, node_key=("node_id",))


def test_prefilter_changes_nothing(elements, tables):
    ways, nodes, refs = elements
    every = extract.point_features(nodes).unionByName(assemble_geometry(ways, nodes, refs, node_key=("node_id",)).select("region", "id", "geom_type", "tags", "pts"))
    calming, rounds = x.core(every)
    assert rows(calming.withColumn("tags", F.to_json("tags"))) == rows(tables["traffic_calming"].withColumn("tags", F.to_json("tags")))
    assert rows(rounds) == rows(tables["roundabouts"])


def test_array_references_equal_table_references(elements, tables):
    ways, nodes, refs = elements
    nds = refs.groupBy("way_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "node_id"))), lambda r: r["node_id"]).alias("nds"))
    roads = extract.road_features(ways.join(nds, "way_id"), nodes, node_key=("node_id",))
    assert rows(x.road_ways(roads).drop("way_id")) == rows(tables["road_ways"])


def test_closed_ways(elements):
    ways, nodes, refs = elements
    kinds = {c: {r[0]: r[1] for r in assemble_geometry(ways, nodes, refs, node_key=("node_id",), closed=c).groupBy("geom_type").count().collect()} for c in ("linestring", "polygon", "both")}
    assert kinds["polygon"]["Polygon"] > kinds["linestring"]["Polygon"]
    assert kinds["both"]["LineString"] == kinds["linestring"]["LineString"]
    assert kinds["both"]["Polygon"] == kinds["polygon"]["Polygon"]


def test_bounds_hold_all_vertices(tables):
    df = tables["road_ways"].select("*", F.posexplode("coords").alias("at", "v"))
    outside = df.where(F.when(F.col("at") % 2 == 0, (F.col("v") < F.col("min_lon")) | (F.col("v") > F.col("max_lon"))).otherwise((F.col("v") < F.col("min_lat")) | (F.col("v") > F.col("max_lat"))))
    assert outside.count() == 0
    assert tables["roundabouts"].where("radius < 0").count() == 0


def test_parquet_tables(spark, tables, tmp_path):
    counts = extract.region_counts(tables, tables["road_ways"].select("region"))
    meta = extract.metadata(counts, "2026-01-01", "now")
    sinks.write_tables(tables, meta, str(tmp_path))
    for name, df in {**tables, "metadata": meta}.items():
        back = spark.read.parquet(f"{tmp_path}/{name}")
        plain = lambda d: d.withColumn("tags", F.to_json("tags")) if "tags" in d.columns else d
        assert rows(plain(back).select(df.columns)) == rows(plain(df))
    one = tables["roundabouts"].where("region = 'ASIA'").limit(1)
    before = spark.read.parquet(f"{tmp_path}/roundabouts").where("region <> 'ASIA'").count()
    sinks.write_table(one, "roundabouts", str(tmp_path))
    after = spark.read.parquet(f"{tmp_path}/roundabouts")
    assert after.where("region = 'ASIA'").count() == 1 and after.where("region <> 'ASIA'").count() == before
    plan = bbox_query(spark.read.parquet(f"{tmp_path}/road_ways"), 50.0, 50.1, -1, -0.9)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(max_lat" in plan


def test_required_values(tables):
    with pytest.raises(Exception, match="road_ways.highway must not be null"):
        checked(tables["road_ways"].withColumn("highway", F.lit(None).cast("string")), "road_ways").collect()


def test_core_bundles(spark, tables, tmp_path):
    sinks.write_core_bundles(tables["traffic_calming"], tables["roundabouts"], "v1", str(tmp_path / "b"))
    assert {(r.version, r.region) for r in bundles.read_header(spark, str(tmp_path / "b")).collect()} == {("v1", r.region) for r in tables["road_ways"].select("region").distinct().collect()}
    back = bundles.read_items(spark, str(tmp_path / "b"), "trafficCalming")
    ours = sinks.calming_items(tables["traffic_calming"]).select("region", "item.*")
    plain = lambda d: d.withColumn("tags", F.to_json("tags"))
    assert rows(plain(back)) == rows(plain(ours.select(back.columns)))
    assert rows(bundles.read_items(spark, str(tmp_path / "b"), "roundabouts")) == rows(tables["roundabouts"])


def test_optional_bundles(spark, tmp_path):
    assert bundles.read_optional(spark, str(tmp_path / "none"), "roadSurfaces").count() == 0
    with pytest.raises(FileNotFoundError):
        bundles.read_optional(spark, str(tmp_path / "none"), "trafficCalming", required=True)
    (tmp_path / "x.json").write_text('{"roadWays":[{"coords":[1,2,3,4],"highway":"track"}]}')
    assert tuple(bundles.read_header(spark, str(tmp_path / "x.json")).first()) == ("", "")
    assert bundles.read_optional(spark, str(tmp_path / "x.json"), "roadWays").count() == 1


def test_dedup(spark):
    df = spark.createDataFrame([("r", 1.0, 2.0, "bridge", 3.0, 4.0, k) for k in (5, 5, None, None)], "region string, lat double, lon double, type string, end_lat double, end_lon double, way_id long")
    assert dedup_segments(df).count() == 3


def test_catalogue(spark, tmp_path):
    (tmp_path / "regions.json").write_text(json.dumps({"regions": [{"id": "a", "name": "A", "continent": "x", "bbox": [1, 2, 3, 4], "geofabrikPath": "p", "estimatedSize": 5}, {"id": "b", "name": "B", "bbox": [1, 2, 3, 4]}]}))
    regions = catalogue.read_regions(spark, str(tmp_path / "regions.json"))
    assert catalogue.find_region(regions, "b").name == "B"
    with pytest.raises(LookupError):
        catalogue.find_region(regions, "c")
    document = json.loads(manifest.slim_document(catalogue.slim_regions(regions), "v", "t").first().value)
    assert [r["id"] for r in document["regions"]] == ["a", "b"] and "continent" not in document["regions"][0]
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.json.gz").write_bytes(b"abc")
    found = catalogue.read_artifacts(spark, str(tmp_path / "f")).select("file", "size", manifest.checksum16(F.col("content")).alias("c")).first()
    assert tuple(found) == ("a.json.gz", 3, "ba7816bf8f01cfea")


def test_collection(spark, tmp_path):
    feature = {"type": "Feature", "id": "n1", "properties": {"traffic_calming": "dip"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}
    (tmp_path / "c.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature, feature]}))
    assert x.traffic_calming(geojson.read_collection(spark, str(tmp_path / "c.json"), "r")).count() == 2
    (tmp_path / "bad.json").write_text('{"type": "FeatureCollection", "features": [')
    with pytest.raises(Exception):
        geojson.read_collection(spark, str(tmp_path / "bad.json"), "r").collect()


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    one = json.dumps({"type": "Feature", "properties": {"highway": "track"}, "geometry": {"type": "LineString", "coordinates": [[1, 2], [3, 4]]}})
    for k in range(3):
        (source / f"{k}.txt").write_text(f"\x1e{one}\n{{bad\n{one}\n")
    stream_road_ways(spark, str(source), "r", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    batch = x.road_ways(geojson.read_sequence(spark, str(source), "r"))
    assert rows(spark.read.parquet(str(tmp_path / "out")).select(batch.columns)) == rows(batch)


def test_service_filter_counts(elements):
    roads = extract.road_features(*elements, node_key=("node_id",))
    kept, all_ = x.road_ways(roads).count(), x.road_ways(roads, service_filter=False).count()
    dropped = roads.where(f.is_line() & f.tagged("highway") & ~f.public_service()).count()
    assert kept + dropped == all_


def test_ids_follow_the_order(tables):
    df = tables["roundabouts"].select("region", "lat", "lon")
    got = with_ids(df, "region", "lat", "lon").orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, df.count() + 1))
    assert [tuple(r)[1:] for r in got] == sorted(map(tuple, df.collect()))


def test_run_stamps(spark):
    from roadspark.functions import time

    one = spark.range(1).select(time.version(), time.instant(), time.version("v"), time.version("")).first()
    assert len(one[0]) == 10 and one[1].endswith("Z") and one[2] == "v" and one[3] == one[0]


def test_tables_from_bundles(spark, tables, tmp_path):
    from roadspark.plans.bundle_tables import bundle_metadata, tables_from_bundles

    core, ways = str(tmp_path / "core"), str(tmp_path / "r-ways.json")
    sinks.write_core_bundles(tables["traffic_calming"], tables["roundabouts"], "v1", core)
    (tmp_path / "r-ways.json").write_text(json.dumps({"version": "v1", "region": "ASIA", "roadWays": [{"coords": [1, 2, 3, -4], "highway": "track"}]}))
    found = tables_from_bundles(spark, core, ways, str(tmp_path / "none"))
    plain = lambda d: d.withColumn("tags", F.to_json("tags"))
    assert rows(plain(found["traffic_calming"])) == rows(plain(tables["traffic_calming"]))
    one = found["road_ways"].first()
    assert (one.highway, one.surface, one.min_lat, one.max_lat, one.min_lon, one.max_lon) == ("track", None, -4, 2, 1, 3)
    assert found["road_surfaces"].count() == 0
    meta = {(r.region, r.key): r.value for r in bundle_metadata(spark, core, found, "now").collect()}
    assert (meta["ASIA", "hasWayData"], meta["EUROPE", "hasWayData"], meta["ASIA", "hasSurfaceData"], meta["ASIA", "version"]) == ("true", "false", "false", "v1")
    with pytest.raises(FileNotFoundError):
        tables_from_bundles(spark, str(tmp_path / "none"), ways, ways)


def test_lines_documents_and_metrics(spark, tables, tmp_path):
    out = tmp_path / "out"
    sinks.write_lines(tables["road_ways"], str(out / "ways"), "v1")
    back = spark.read.schema("region string, version string, highway string, surface string, coords array<double>").json(str(out / "ways"))
    assert rows(back.drop("version")) == rows(tables["road_ways"].select("region", "highway", "surface", "coords"))
    assert {r.version for r in back.collect()} == {"v1"}
    regions = spark.createDataFrame([(0, "a", "A", [1.0, 2.0], 3)], "position int, id string, name string, bbox array<double>, estimatedSize long")
    sinks.write_document(manifest.slim_document(regions, "v", "t"), str(out / "regions"))
    assert json.loads(spark.read.text(str(out / "regions")).first().value)["version"] == "v"
    size = sinks.json_bytes(back)
    found = {r.folder: r for r in sinks.write_metrics(spark, str(out), {"ways": size}, 2.0).collect()}
    assert found["ways"].raw_bytes == size and found["ways"].smaller_percent == round((1 - found["ways"].bytes / size) * 100, 1) > 0
    assert found["regions"].smaller_percent is None and found["regions"].seconds == 2.0


def test_what_lines_hold_reads_back(spark, tables, tmp_path):
    from roadspark.plans.bundle_tables import bundle_metadata, tables_from_bundles

    plain = lambda d: d.withColumn("tags", F.to_json("tags")) if "tags" in d.columns else d
    sinks.write_lines(tables["road_ways"], str(tmp_path / "ways"), "v1")
    sinks.write_lines(tables["road_surfaces"], str(tmp_path / "surfaces"), "v1")
    core, rounds = sinks.write_core_lines(tables["traffic_calming"], tables["roundabouts"], "v1", str(tmp_path / "core"))
    found = tables_from_bundles(spark, core, str(tmp_path / "ways"), str(tmp_path / "surfaces"), rounds)
    for name, df in tables.items():
        assert rows(plain(found[name]).select(plain(df).columns)) == rows(plain(df)), name
    meta = {(r.region, r.key): r.value for r in bundle_metadata(spark, core, found, "now").collect()}
    assert (meta["ASIA", "version"], meta["ASIA", "hasWayData"], meta["ASIA", "hasSurfaceData"]) == ("v1", "true", "true")
    # Files of another kind are an error; a document of several lines, and no items at all, are not.
    with pytest.raises(ValueError, match="holds no roadWays"):
        bundles.read_items(spark, str(tmp_path / "core" / "roundabouts"), "roadWays")
    (tmp_path / "long.json").write_text(json.dumps({"version": "v", "region": "r", "roadWays": [{"coords": [1, 2, 3, 4], "highway": "track"}]}, indent=2))
    assert [tuple(r) for r in bundles.read_items(spark, str(tmp_path / "long.json"), "roadWays").collect()] == [("r", [1, 2, 3, 4], "track", None)]
    sinks.write_lines(tables["road_ways"].limit(0), str(tmp_path / "none"), "v1")
    assert bundles.read_items(spark, str(tmp_path / "none"), "roadWays").count() == 0


def test_a_document_is_bounded(tables):
    with pytest.raises(ValueError, match="no single document"):
        sinks.core_bundles(tables["traffic_calming"], tables["roundabouts"], "v", most=3)


def test_counts_from_elements_equal_those_of_the_tables(elements, tables):
    ways, nodes, refs = elements
    counted = extract.counted(ways, nodes, refs, node_key=("node_id",))
    assert rows(counted) == rows(extract.region_counts(tables, ways.select("region")))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("collect_list") <= 4  # one assembly: a partial and a final aggregate, twice in the text
