"""Bundles are read strictly: what is cut is an error, versions agree, a header names all regions."""

import gzip
import json

import pytest

from roadspark import sinks
from roadspark.plans.bundle_tables import bundle_metadata, tables_from_bundles
from roadspark.sources import bundles

WAY = {"version": "v", "region": "r", "coords": [1.0, 2.0, 3.0, 4.0], "highway": "track"}


def ways(spark, path):
    return sorted((r.region, r.highway) for r in bundles.read_items(spark, str(path), "roadWays").collect())


def test_a_cut_line_is_an_error(spark, tmp_path):
    good = json.dumps(WAY)
    (tmp_path / "a.json").write_text(good + "\n" + good + "\n")
    assert ways(spark, tmp_path) == [("r", "track")] * 2
    (tmp_path / "b.json").write_text(good + "\n" + good[:-9])
    with pytest.raises(Exception, match="(?i)malformed"):
        ways(spark, tmp_path)
    with pytest.raises(Exception, match="(?i)malformed"):
        bundles.read_header(spark, str(tmp_path)).collect()


def test_a_cut_document_is_an_error(spark, tmp_path):
    document = json.dumps({"version": "v", "region": "r", "roadWays": [{k: WAY[k] for k in ("coords", "highway")}]}, indent=1)
    (tmp_path / "a.json").write_text(document)
    assert ways(spark, tmp_path) == [("r", "track")]
    (tmp_path / "b.json").write_text(document[:-5])
    with pytest.raises(Exception, match="(?i)malformed"):
        ways(spark, tmp_path)
    with pytest.raises(Exception, match="(?i)malformed"):
        bundles.read_header(spark, str(tmp_path)).collect()


def test_a_cut_gzip_file_is_an_error(spark, tmp_path):
    whole = gzip.compress("".join(json.dumps(WAY | {"highway": f"t{k}"}) + "\n" for k in range(2000)).encode())
    (tmp_path / "a.json.gz").write_bytes(whole)
    assert len(ways(spark, tmp_path)) == 2000
    (tmp_path / "a.json.gz").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception):
        ways(spark, tmp_path)


@pytest.mark.parametrize("wrong", [{"coords": "x"}, {"coords": [1, "x"]}, {"region": {"a": 1}}])
def test_values_of_other_types_are_errors(spark, tmp_path, wrong):
    (tmp_path / "a.json").write_text(json.dumps(WAY) + "\n" + json.dumps(WAY | wrong) + "\n")
    if "region" in wrong:  # a text may be anything; it is kept as it is written
        assert len(ways(spark, tmp_path)) == 2
        return
    with pytest.raises(Exception):
        ways(spark, tmp_path)


def core(spark, *rows):
    calming = spark.createDataFrame([(r, 1.0, 2.0, "dip", None, None, None, None) for r, kind in rows if kind == "calming"], "region string, lat double, lon double, type string, end_lat double, end_lon double, way_id long, tags map<string,string>")
    rounds = spark.createDataFrame([(r, 1.0, 2.0, 3.0, "mini_roundabout") for r, kind in rows if kind == "round"], "region string, lat double, lon double, radius double, type string")
    return calming, rounds


def road(spark, *regions):
    return spark.createDataFrame([(r, "track", None, [1.0, 2.0]) for r in regions], "region string, highway string, surface string, coords array<double>")


@pytest.mark.parametrize("rows", [(("A", "calming"), ("B", "round")), (("A", "round"), ("B", "round")), ()])
def test_metadata_of_every_region_of_a_run(spark, tmp_path, rows):
    path = str(tmp_path / "core")
    items, rounds = sinks.write_core_lines(*core(spark, *rows), "v1", path, ["A", "B", "C"])
    header = f"{path}/{bundles.HEADER}"
    assert sorted(map(tuple, bundles.read_header(spark, items, header).collect())) == [("v1", "A"), ("v1", "B"), ("v1", "C")]
    sinks.write_lines(road(spark, "B"), str(tmp_path / "ways"), "v1", ["A", "B", "C"])
    found = tables_from_bundles(spark, items, str(tmp_path / "ways"), str(tmp_path / "none"), rounds, header)
    meta = {(r.region, r.key): r.value for r in bundle_metadata(spark, items, found, "now", header).collect()}
    assert len(meta) == 15
    assert [(meta[r, "version"], meta[r, "region"], meta[r, "hasWayData"], meta[r, "hasSurfaceData"]) for r in "ABC"] == [("v1", "A", "false", "false"), ("v1", "B", "true", "false"), ("v1", "C", "false", "false")]
    assert found["roundabouts"].count() == sum(kind == "round" for _, kind in rows)


def test_other_versions_are_errors(spark, tmp_path):
    path = str(tmp_path / "core")
    items, rounds = sinks.write_core_lines(*core(spark, ("A", "calming")), "v2", path, ["A"])
    header = f"{path}/{bundles.HEADER}"
    sinks.write_lines(road(spark, "A"), str(tmp_path / "stale"), "v1")
    sinks.write_lines(road(spark, "A", "B"), str(tmp_path / "more"), "v2")
    sinks.write_lines(road(spark, "A"), str(tmp_path / "fresh"), "v2")
    none = str(tmp_path / "none")
    with pytest.raises(Exception, match="items of A have version 'v1', its core has 'v2'"):
        tables_from_bundles(spark, items, str(tmp_path / "stale"), none, rounds, header)["road_ways"].collect()
    with pytest.raises(Exception, match="items of B have version 'v2', its core has none"):
        tables_from_bundles(spark, items, none, str(tmp_path / "more"), rounds, header)["road_surfaces"].collect()
    assert tables_from_bundles(spark, items, str(tmp_path / "fresh"), none, rounds, header)["road_ways"].count() == 1
    assert tables_from_bundles(spark, items, str(tmp_path / "stale"), none, rounds, header, same_version=False)["road_ways"].count() == 1
    # The check is part of the read: it needs no pass of its own.
    plan = tables_from_bundles(spark, items, str(tmp_path / "fresh"), none, rounds, header)["road_ways"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_two_versions_of_one_core_are_an_error(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / f"{k}.json").write_text(json.dumps({"version": f"v{k}", "region": "r", "trafficCalming": [], "roundabouts": []}))
    with pytest.raises(ValueError, match="several versions"):
        tables_from_bundles(spark, str(tmp_path), str(tmp_path / "none"), str(tmp_path / "none"))


def test_counts_of_core_lines(spark, tmp_path):
    written = {}
    sinks.write_core_lines(*core(spark, ("A", "calming"), ("A", "calming"), ("B", "round")), "v1", str(tmp_path / "core"), ["A", "B"], written)
    assert (written["traffic_calming"].by_region, written["roundabouts"].by_region) == ({"A": 2, "B": 0}, {"A": 0, "B": 1})
