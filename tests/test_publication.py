"""Publication: tables switch together, regions are replaced, unfinished runs show nothing."""

import os

import pytest
from pyspark.sql import functions as F

from roadspark import publication as P
from roadspark import schemas, sinks
from roadspark.storage import exists, names, partition_folder, remove


def frames(spark, **rows):
    """The four tables of a few (region, number) pairs each; the number is a latitude."""
    way = lambda r, n: (r, "track", None, [1.0, float(n)], float(n), float(n), 1.0, 1.0)
    make = {
        "traffic_calming": lambda r, n: (r, float(n), 1.0, "dip", None, None, None, None),
        "roundabouts": lambda r, n: (r, float(n), 1.0, 3.0, "mini_roundabout"),
        "road_surfaces": lambda r, n: (r, "asphalt", [1.0, float(n)], float(n), float(n), 1.0, 1.0),
        "road_ways": way,
    }
    return {t: spark.createDataFrame([make[t](*x) for x in rows.get(t, [])], P.TABLES[t]) for t in make}


def shown(spark, path, table, at=None):
    lat = "min_lat" if table.startswith("road_") else "lat"
    return sorted((r.region, r[lat]) for r in P.read_published(spark, path, table, at).collect())


def meta(spark, path, at=None):
    return {(r.region, r.key): r.value for r in P.read_published(spark, path, "metadata", at).collect()}


def test_runs_replace_their_regions(spark, tmp_path):
    path = str(tmp_path / "p")
    assert P.latest(spark, path) is None and P.read_published(spark, path, "road_ways").count() == 0
    first = frames(spark, traffic_calming=[("A", 1), ("B", 2)], roundabouts=[("A", 1), ("A", 3), ("B", 2)], road_ways=[("A", 1), ("B", 2)], road_surfaces=[("B", 2)])
    commit = P.publish(first, path, ["A", "B", "nothing"], "v1", "now")
    assert commit.number == 0 and commit.counts["roundabouts"] == {"A": 2, "B": 1, "nothing": 0}
    found = meta(spark, path)
    assert len(found) == 15 and (found["A", "hasSurfaceData"], found["A", "hasWayData"], found["nothing", "hasWayData"], found["nothing", "version"]) == ("false", "true", "false", "v1")
    # B again, now without roundabouts and surfaces; A stays.
    P.publish(frames(spark, traffic_calming=[("B", 9)], road_ways=[("B", 9)]), path, ["B"], "v2", "later")
    assert shown(spark, path, "roundabouts") == [("A", 1.0), ("A", 3.0)]
    assert shown(spark, path, "road_surfaces") == []
    assert shown(spark, path, "road_ways") == [("A", 1.0), ("B", 9.0)]
    found = meta(spark, path)
    assert (found["A", "version"], found["B", "version"], found["B", "hasSurfaceData"], found["B", "createdAt"]) == ("v1", "v2", "false", "later")
    # The first commit is still readable, until it is vacuumed away.
    assert shown(spark, path, "roundabouts", 0) == [("A", 1.0), ("A", 3.0), ("B", 2.0)]
    assert P.vacuum(spark, path) == [] and shown(spark, path, "road_ways") == [("A", 1.0), ("B", 9.0)]
    with pytest.raises(LookupError):
        P.read_published(spark, path, "road_ways", 0)
    P.publish(frames(spark), path, ["A", "nothing"], "v3", "now")
    assert P.vacuum(spark, path) == [commit.run] and shown(spark, path, "road_ways") == [("B", 9.0)]
    assert meta(spark, path)["A", "version"] == "v3"


def test_a_run_killed_between_two_tables_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    P.publish(frames(spark, road_ways=[("A", 1)], roundabouts=[("A", 1)]), path, ["A"], "v1", "now")
    before = {t: shown(spark, path, t) for t in ("road_ways", "roundabouts")}, meta(spark, path)
    write = P._write

    def killed(df, name, *rest):
        if name == "road_surfaces":
            raise KeyboardInterrupt
        return write(df, name, *rest)

    monkeypatch.setattr(P, "_write", killed)
    with pytest.raises(KeyboardInterrupt):
        P.publish(frames(spark, road_ways=[("A", 7)], roundabouts=[("A", 7)]), path, ["A"], "v2", "now", run="dead")
    monkeypatch.undo()
    assert exists(spark, f"{path}/roundabouts/run=dead")
    assert ({t: shown(spark, path, t) for t in ("road_ways", "roundabouts")}, meta(spark, path)) == before
    # A commit whose job did not end does not count either.
    (tmp_path / "p/commits/00000001/_temporary").mkdir(parents=True)
    assert P.latest(spark, path).number == 0
    assert P.vacuum(spark, path) == ["dead"] and names(spark, f"{path}/commits") == ["00000000"]
    P.publish(frames(spark, road_ways=[("A", 8)]), path, ["A"], "v2", "now")
    assert shown(spark, path, "road_ways") == [("A", 8.0)] and shown(spark, path, "roundabouts") == []


@pytest.mark.parametrize("bad, message", [({"road_ways": [("A", 1), ("C", 2)]}, "does not name"), ({"roundabouts": [(None, 2)]}, "region null")])
def test_rows_of_other_regions_are_refused(spark, tmp_path, bad, message):
    path = str(tmp_path / "p")
    P.publish(frames(spark, road_ways=[("A", 1)]), path, ["A"], "v1", "now")
    with pytest.raises(Exception, match=message):
        P.publish(frames(spark, **bad), path, ["A"], "v2", "now")
    assert P.latest(spark, path).number == 0 and meta(spark, path)["A", "version"] == "v1"


def test_what_a_run_needs(spark, tmp_path):
    for tables, regions in ((frames(spark), []), (frames(spark), [""]), ({"road_ways": frames(spark)["road_ways"]}, ["A"])):
        with pytest.raises(ValueError):
            P.publish(tables, str(tmp_path / "p"), regions)
    null = frames(spark, road_ways=[("A", 1)])
    null["road_ways"] = null["road_ways"].withColumn("highway", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="road_ways.highway must not be null"):
        P.publish(null, str(tmp_path / "p"), ["A"])
    assert P.latest(spark, str(tmp_path / "p")) is None
    with pytest.raises(ValueError, match="regions at most"):
        sinks.Written([str(k) for k in range(2000)])


def test_odd_region_names(spark, tmp_path):
    path, odd = str(tmp_path / "p"), ["007", "a/b c", "x=ü%", "2026-01-01"]
    P.publish(frames(spark, road_ways=[(r, 1) for r in odd]), path, odd, "v", "now")
    P.publish(frames(spark, road_ways=[("007", 2)]), path, ["007", "a/b c"], "v", "now")
    assert shown(spark, path, "road_ways") == sorted([("007", 2.0), ("x=ü%", 1.0), ("2026-01-01", 1.0)])
    assert P.read_published(spark, path, "road_ways").columns == spark.createDataFrame([], schemas.ROAD_WAYS).columns


def test_readers_open_only_what_is_visible(spark, tmp_path):
    path = str(tmp_path / "p")
    for n in (1, 2):
        P.publish(frames(spark, road_ways=[("A", n), ("B", n)]), path, ["A", "B"], "v", "now")
    df = P.read_published(spark, path, "road_ways").where("region = 'A'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "run#" in plan.split("PartitionFilters")[1]
    run = P.latest(spark, path).run
    assert {os.path.relpath(r[0].removeprefix("file:"), path).split("/")[1:3] == [f"run={run}", "region=A"] for r in df.select("_metadata.file_path").collect()} == {True}


def test_versions_of_regions(spark, tmp_path):
    path = str(tmp_path / "p")
    P.publish(frames(spark), path, ["A", "B", "C"], {"A": "v1", "B": ""}, "now")
    found = meta(spark, path)
    today = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd")).first()[0]
    assert (found["A", "version"], found["B", "version"], found["C", "version"]) == ("v1", today, today)


def test_write_table_removes_what_a_region_had(spark, tmp_path):
    path = str(tmp_path)
    rows = frames(spark, roundabouts=[("A", 1), ("B/1", 2), ("C", 3)])["roundabouts"]
    assert sinks.write_table(rows, "roundabouts", path, ["A", "B/1", "C"]).by_region == {"A": 1, "B/1": 1, "C": 1}
    assert exists(spark, f"{path}/roundabouts/{partition_folder(spark, 'region', 'B/1')}")
    written = sinks.write_table(rows.where("region = 'A'"), "roundabouts", path, ["A", "B/1"])
    assert (written.rows, written.by_region) == (1, {"A": 1, "B/1": 0})
    assert sorted(r.region for r in spark.read.parquet(f"{path}/roundabouts").collect()) == ["A", "C"]
    # Without the regions of the run only those with rows are replaced.
    sinks.write_table(rows.where("region = 'C'").withColumn("lat", F.lit(7.0)), "roundabouts", path)
    assert sorted((r.region, r.lat) for r in spark.read.parquet(f"{path}/roundabouts").collect()) == [("A", 1.0), ("C", 7.0)]
    with pytest.raises(ValueError, match="does not name"):
        sinks.write_table(rows, "roundabouts", path, ["A"])
    remove(spark, f"{path}/roundabouts/nothing")


def test_counts_come_from_the_write(spark, tmp_path):
    """Rows and bytes of lines, without reading them back."""
    rows = frames(spark, road_ways=[("A", 1), ("A", 2), ("B", 3)])["road_ways"]
    written = sinks.write_lines(rows, str(tmp_path / "ways"), "v1", ["A", "B", "C"])
    assert (written.rows, written.by_region) == (3, {"A": 2, "B": 1, "C": 0})
    text = spark.read.text(str(tmp_path / "ways"))
    assert written.raw_bytes == sum(len(r.value.encode()) + 1 for r in text.collect())
    assert {r.region for r in spark.read.schema("region string").json(str(tmp_path / "ways")).collect()} == {"A", "B"}
    assert all('"region":"' in r.value and '"version":"v1"' in r.value for r in text.collect())
    found = sinks.write_metrics(spark, str(tmp_path), {"ways": written.raw_bytes}).first()
    assert found.raw_bytes == written.raw_bytes
    assert sinks.write_lines(rows.limit(0), str(tmp_path / "none"), "v1", ["A"]).by_region == {"A": 0}
