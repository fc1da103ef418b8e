"""The stream of all tables equals the batch, restarts double nothing, rejected lines are kept."""

import json
from collections import Counter

import pytest

from roadspark.sources import geojson
from roadspark.streaming import geojson as stream


def feature(properties, coordinates, kind="LineString"):
    return json.dumps({"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": coordinates}})


TWO, RING = [[1, 2], [3, 4]], [[0, 0], [0.001, 0], [0.001, 0.001], [0, 0.001], [0, 0]]
LINES = [
    feature({"highway": "track", "surface": "mud"}, TWO),
    feature({"highway": "footway", "surface": "mud"}, TWO),
    feature({"highway": "service", "service": "driveway"}, TWO),
    feature({"highway": "primary", "bridge": "yes"}, TWO),
    feature({"highway": "residential", "junction": "roundabout"}, RING),
    feature({"traffic_calming": "hump;table"}, [1, 2], "Point"),
    feature({"highway": "mini_roundabout"}, [1, 2], "Point"),
    "",
    "{bad",
]
EXPECTED = {"traffic_calming": 3, "roundabouts": 2, "road_ways": 3, "road_surfaces": 1}


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")


def run(spark, folders, **options):
    stream.stream_tables(spark, str(folders[0]), "r", folders[1], folders[2], **options).awaitTermination(120)


def rows(df):
    return Counter(map(repr, df.drop("batch").select(sorted(c for c in df.columns if c != "batch")).collect()))


def test_all_tables(spark, folders):
    source, out, _ = folders
    for k in range(3):
        (source / f"{k}.txt").write_text("\n".join(LINES) + "\n")
    run(spark, folders, files_per_trigger=2)
    batch = stream.tables_of(geojson.read_sequence(spark, str(source), "r"))
    for name, df in batch.items():
        got = stream.read_streamed(spark, out, name)
        assert got.count() == 3 * EXPECTED[name] and rows(got) == rows(df), name
    counts = stream.read_streamed(spark, out, "counts").orderBy("batch").collect()
    assert [r.batch for r in counts] == [0, 1]
    assert {c: sum(r[c] for r in counts) for c in ("features", "blank", "rejected", *EXPECTED)} == {"features": 21, "blank": 3, "rejected": 3} | {t: 3 * n for t, n in EXPECTED.items()}
    assert [r.value for r in stream.read_rejected(spark, out).collect()] == ["{bad"] * 3
    # More files later: only they are read.
    (source / "more.txt").write_text(LINES[0] + "\n")
    run(spark, folders)
    assert stream.read_streamed(spark, out, "road_ways").count() == 3 * EXPECTED["road_ways"] + 1
    assert stream.complete_batches(spark, out) == [0, 1, 2]


def test_a_restart_doubles_nothing(spark, folders, monkeypatch):
    source, out, _ = folders
    for k in range(2):
        (source / f"{k}.txt").write_text("\n".join(LINES) + "\n")
    plain, failures = stream.checked, []

    def failing(df, name):
        if name == "road_surfaces" and not failures:
            failures.append(name)
            raise RuntimeError("lost")
        return plain(df, name)

    monkeypatch.setattr(stream, "checked", failing)
    with pytest.raises(Exception, match="lost"):
        run(spark, folders, files_per_trigger=1)
    # Tables of the batch are there in part, but no reader sees them.
    assert stream.read_streamed(spark, out, "road_ways").count() == 0 and stream.read_rejected(spark, out).count() == 0
    run(spark, folders, files_per_trigger=1)
    for name, n in EXPECTED.items():
        assert stream.read_streamed(spark, out, name).count() == 2 * n, name
    assert stream.read_rejected(spark, out).count() == 2
    # The same batch once more, as after a lost commit of the stream.
    again = spark.createDataFrame([(t,) for t in LINES], "value string")
    stream.write_batch(again, 1, "r", out)
    for name, n in EXPECTED.items():
        assert stream.read_streamed(spark, out, name).count() == 2 * n, name


def test_nothing_arrives(spark, folders):
    run(spark, folders)
    assert stream.read_streamed(spark, folders[1], "road_ways").count() == stream.read_streamed(spark, folders[1], "counts").count() == 0
    (folders[0] / "a.txt").write_text("\n{bad\n")
    run(spark, folders)
    assert stream.read_streamed(spark, folders[1], "road_ways").count() == 0
    assert tuple(stream.read_streamed(spark, folders[1], "counts").select("features", "blank", "rejected").first()) == (0, 1, 1)
