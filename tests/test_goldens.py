"""Golden cases, read off the semantics: one feature or value in, what must come out."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from roadspark.functions import geo
from roadspark.functions.tags import way_id_of
from roadspark.operators import features as x
from roadspark.plans import manifest
from roadspark.sources import geojson

RING = [[0, 0], [0.001, 0], [0.001, 0.001], [0, 0.001], [0, 0]]


def line(properties, coordinates, kind="LineString", id=None):
    return json.dumps({"type": "Feature", **({"id": id} if id is not None else {}), "properties": properties, "geometry": {"type": kind, "coordinates": coordinates}})


def features(spark, *lines):
    return geojson.features_of_lines(spark.createDataFrame([(t,) for t in lines], "value string"), "r")


def ways(spark, *lines):
    return [(tuple(r.coords), r.highway, r.surface) for r in x.road_ways(features(spark, *lines)).collect()]


def surfaces(spark, *lines):
    return [r.surface for r in x.road_surfaces(features(spark, *lines)).collect()]


def calming(spark, *lines):
    return [(r.type, r.lat, r.lon, r.end_lat, r.end_lon, r.way_id, r.tags) for r in x.traffic_calming(features(spark, *lines)).collect()]


def rounds(spark, *lines):
    return [(r.type, round(r.lat, 7), round(r.lon, 7), r.radius) for r in x.roundabouts(features(spark, *lines)).collect()]


TWO = [[1, 2], [3, 4]]


@pytest.mark.parametrize("end", ["\u3000", "\u2003", "\u00a0", "\ufeff", "\t"])
def test_lines_are_trimmed_of_all_white_space(spark, end):
    assert ways(spark, end + line({"highway": "track"}, [[1, 2], [3, 4]]) + end) == [((1, 2, 3, 4), "track", None)]


def test_counts_of_the_same_pass(spark):
    good = line({"highway": "track"}, [[1, 2], [3, 4]])
    counts = Observation("lines")
    df = geojson.features_of_lines(spark.createDataFrame([(t,) for t in (good, " ", "{bad", good)], "value string"), "r", counts=counts)
    assert x.road_ways(df).count() == 2 and counts.get == {"features": 2, "blank": 1, "rejected": 1}


def test_the_last_name_of_an_id(spark):
    regions = spark.createDataFrame([(k, "a", f"name {k}") for k in range(50)], "position int, id string, name string").repartition(7)
    assert manifest.region_names(regions).first().name == "name 49"


def test_sequence_lines(spark):
    good = line({"highway": "track"}, TWO)
    text = ["\x1e" + good, "", "  \x1e ", "{bad", good + " xyz", "null", '{"type":"Feature","properties":null,"geometry":null}', "[1]"]
    assert ways(spark, *text) == [((1, 2, 3, 4), "track", None)]
    counts = geojson.count_lines(spark.createDataFrame([(t,) for t in text], "value string")).first()
    assert tuple(counts) == (1, 2, 5)


@pytest.mark.parametrize(
    "properties, coordinates, kind, expected",
    [
        ({"highway": "track"}, [1, 2], "Point", []),
        ({"highway": "track"}, [RING], "Polygon", []),
        ({}, TWO, "LineString", []),
        ({"highway": ""}, TWO, "LineString", []),
        ({"highway": "service", "service": "driveway"}, TWO, "LineString", []),
        ({"highway": "service", "service": "parking_aisle"}, TWO, "LineString", []),
        ({"highway": "service", "service": "alley"}, TWO, "LineString", [((1, 2, 3, 4), "service", None)]),
        ({"highway": "service"}, TWO, "LineString", [((1, 2, 3, 4), "service", None)]),
        ({"highway": "track", "service": "driveway"}, TWO, "LineString", [((1, 2, 3, 4), "track", None)]),
        ({"highway": "track"}, [[1, 2]], "LineString", []),
        ({"highway": "track"}, [[1, 2, 9], [3, 4, 9]], "LineString", [((1, 2, 3, 4), "track", None)]),
    ],
)
def test_road_ways(spark, properties, coordinates, kind, expected):
    assert ways(spark, line(properties, coordinates, kind)) == expected


@pytest.mark.parametrize("raw, way, surface", [("asphalt", "asphalt", ["asphalt"]), ("sett", "cobblestone", ["cobblestone"]), ("mud", "dirt", ["dirt"]), ("Asphalt", None, ["unknown"]), ("metal", None, ["unknown"]), ("asphalt;gravel", None, ["unknown"]), ("constructor", None, ["unknown"]), ("", None, []), (None, None, [])])
def test_surfaces(spark, raw, way, surface):
    one = line({"highway": "track", **({"surface": raw} if raw is not None else {})}, TWO)
    assert ways(spark, one)[0][2] == way
    assert surfaces(spark, one) == surface


@pytest.mark.parametrize(
    "value, types",
    [("hump;table", ["speed_bump", "speed_bump"]), (" chicane ; choker ", ["chicane", "narrowing"]), ("double_dip;;cushion", ["dip", "speed_bump"]), ("rumble_strip", []), ("Bump", []), ("", []), (" dip﻿", ["dip"])],
)
def test_calming_points(spark, value, types):
    assert [r[0] for r in calming(spark, line({"traffic_calming": value}, [1, 2], "Point"))] == types


def test_one_feature_in_several_tables(spark):
    both = line({"highway": "speed_camera", "enforcement": "maxspeed"}, [1, 2], "Point")
    assert [r[0] for r in calming(spark, both)] == ["speed_camera"]
    island = line({"traffic_calming": "island", "highway": "mini_roundabout"}, [1, 2], "Point")
    assert [r[0] for r in calming(spark, island)] == ["island"]
    assert rounds(spark, island) == [("mini_roundabout", 2, 1, 3)]
    arch = line({"junction": "roundabout", "bridge": "yes"}, RING)
    assert [r[0] for r in calming(spark, arch)] == ["bridge"]
    assert [r[0] for r in rounds(spark, arch)] == ["roundabout"]


def test_roundabouts(spark):
    closed = ("roundabout", 0.0004, 0.0004, 94)
    assert rounds(spark, line({"junction": "roundabout"}, RING)) == [closed]
    assert rounds(spark, line({"junction": "roundabout"}, [RING, TWO], "Polygon")) == [closed]
    assert rounds(spark, line({"junction": "roundabout"}, RING[:-1])) == [("roundabout", 0.0005, 0.0005, 79)]
    assert rounds(spark, line({"junction": "roundabout"}, [1, 2], "Point")) == []
    assert rounds(spark, line({"junction": "roundabout"}, [[RING]], "MultiPolygon")) == []


def test_bridges(spark):
    assert calming(spark, line({"bridge": "yes", "tunnel": "yes"}, [[1, 2], [3, 4], [5, 6]], id="w12")) == [("bridge", 2, 1, 6, 5, 12, None)]
    assert calming(spark, line({"bridge": "viaduct"}, TWO)) == []
    assert calming(spark, line({"bridge": "yes"}, [RING], "Polygon")) == []
    assert calming(spark, line({"tunnel": "yes", "name": "", "ref": "A1", "foo": "x"}, TWO))[0][6] == {"ref": "A1"}


def test_way_ids(spark):
    rows = spark.createDataFrame([(v,) for v in ("w12", "w12x", "way/12", "n12", "12", None)], "id string")
    assert [r[0] for r in rows.select(way_id_of(F.col("id"))).collect()] == [12, 12, None, None, None, None]


def test_numbers(spark):
    one = spark.range(1)
    ring = F.array(*[F.struct(F.lit(float(a)).alias("lon"), F.lit(float(b)).alias("lat")) for a, b in RING])
    lit = [F.lit(float(v)) for v in (0, 0, 0, 1, 180)]
    got = one.select(geo.haversine(*lit[:4]), geo.haversine(*lit[:3], lit[4]), geo.length(ring)).first()
    assert got[0] == pytest.approx(111194.92664, abs=1e-4)
    assert got[1] == pytest.approx(20015086.79602, abs=1e-4)
    assert got[2] == pytest.approx(444.77971, abs=1e-4)
    bounds = geo.flat_bbox(F.array(*[F.lit(float(v)) for v in (1, 2, 3, -4, 9)]))
    assert one.select(*[c.alias(k) for k, c in bounds.items()]).first().asDict() == {"min_lat": -4, "max_lat": 2, "min_lon": 1, "max_lon": 3}


def test_manifest(spark):
    names = ["a.json.gz", "a-ways.json.gz", "b-ways.json.gz", "x-ways-y.json.gz", "a.sqlite.gz", "c.json.gz", "notes.txt"]
    files = spark.createDataFrame([(n, 10 + k, n.encode()) for k, n in enumerate(names)], "file string, size long, content binary")
    regions = spark.createDataFrame([(0, "a", "first"), (1, "a", "last"), (2, "c", "")], "position int, id string, name string")
    found = {r.region: r for r in manifest.manifest_regions(files, regions).collect()}
    assert set(found) == {"a", "c"}
    assert (found["a"].name, found["a"].way_size, found["a"].surface_size, found["a"].sqlite_size) == ("last", 11, None, 14)
    assert found["c"].name == "c"
    rows = manifest.manifest_regions(files, regions)
    assert tuple(manifest.totals(rows).first()) == (2, 10 + 11 + 15)
    document = json.loads(manifest.manifest_document(rows, "v", "t").first().value)
    assert set(document["regions"]) == {"a", "c"}
    assert "surfaceSize" not in document["regions"]["a"] and document["regions"]["a"]["waySize"] == 11
