"""What the large steps of assembly, writing and streaming do only once, or in as many tasks as there are."""

import pytest

from roadspark import queries as q
from roadspark.operators.geometry import assemble_geometry

SF = "/root/testdata/sf0.001"


class Stopped(Exception):
    pass


def _inputs(spark):
    ways = spark.createDataFrame([("A", 1, ("yes",)), ("A", 1, ("yes",)), ("B", 1, (None,))], "region string, way_id long, tags struct<area:string>")
    nodes = spark.createDataFrame([(k, float(k), float(-k)) for k in range(1, 4)], "node_id long, lat double, lon double")
    refs = spark.createDataFrame([(1, 2, 3), (1, 1, 2), (1, 3, 1)], "way_id long, seq long, node_id long")
    return ways, nodes, refs


def test_repeated_ways_repeat_no_vertices(spark):
    got = assemble_geometry(*_inputs(spark), node_key=("node_id",))
    assert got.columns[:3] == ["region", "way_id", "tags"]
    assert sorted((r.region, r.n_points, [p.lat for p in r.pts]) for r in got.collect()) == [(g, 3, [2.0, 3.0, 1.0]) for g in "AAB"]


def test_places_are_dealt_before_they_are_collected(spark):
    plan = assemble_geometry(*_inputs(spark), node_key=("node_id",))._jdf.queryExecution().executedPlan().toString()
    lists = [k for k, line in enumerate(plan.split("\n")) if "collect_list" in line]
    lines = plan.split("\n")
    assert len(lists) == 2 and not any("Exchange" in line for line in lines[lists[0] : lists[1]])


def test_counts_come_from_written_files(spark, monkeypatch):
    read = []

    def counts(tables, regions, own=q.extract.region_counts):
        read.extend(f for df in tables.values() for f in df.inputFiles())
        return own(tables, regions)

    monkeypatch.setattr(q.extract, "region_counts", counts)
    assert q.written_tables(spark, SF).where("table_name = 'metadata'").count() > 0
    assert read and all("/tables-" in f for f in read)


def test_stream_files_grow_with_tasks(spark, monkeypatch):
    seen = []

    def stop(spark, source, *rest, files_per_trigger):
        seen.append((sum(n.startswith("part-") for n in q.names(spark, source)), files_per_trigger))
        raise Stopped

    monkeypatch.setattr(q.stream, "stream_tables", stop)
    own = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        with pytest.raises(Stopped):
            q.streamed_tables(spark, SF)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files, each = seen[0]
    assert files > 12 and files / 2 <= each < files
