"""Secret scans: base spans against plain patterns, the network against itself and held-out findings."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadspark.llm import secretscan as s
from roadspark.llm.common import table

KEY = "9f3Ka7QzP0xLm2Vt8RbN4cYw6HsJ1dGe"


def plain(text):
    """The rules, written apart."""
    out = []
    for m in re.finditer(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", text):
        out += [(m.start(), 0, "assign", m.end())] * (len(m[1]) >= 8)
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{b}:{e}" for b, _, k, e in sorted(out))


@pytest.fixture(scope="module")
def net(spark):
    return s.train(table(spark, "/root/testdata/sf0.1", "documents"))


def test_base_spans(spark, net):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    got = {r.doc_id: r for r in s.digests(docs, net).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows) and sum(r.n_assign for r in got.values()) > 100
    for doc_id, text in rows:
        expected = plain(text or "")
        assert got[doc_id].base_sha256 == hashlib.sha256(expected.encode()).hexdigest()
        ours = [x for x in got[doc_id].spans.split(",") if x and not x.startswith("net:")]
        assert ",".join(ours) == expected
        assert len(got[doc_id].spans.split(",")) - len(ours) == got[doc_id].n_added or not got[doc_id].spans


@pytest.mark.parametrize("seed", range(4))
def test_rules_on_odd_texts(seed):
    rng = random.Random(seed)
    parts = ["token", "TOKEN", "api_key", "apiKey", "Key", "tokKen", "ſecret", "password", " ", "  ", ":", "=", '"', "'", "abcdefgh", "a.b-c=d/", "AKIA", "AKIAABCDEFGH1234", "0123456789abcdef" * 2, "f" * 31, "é", "😀", "\n", ",", "x"]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        assert ",".join(f"{s.KINDS[k]}:{b}:{e}" for b, k, e in s.base_spans(text)) == plain(text)


def test_held_out_findings(spark, net):
    """Of documents that were not learned from, what the rules cover scores high, the rest does not."""
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    turned = docs.withColumn("key", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(0)).otherwise(2))
    other = {0: next(str(k) for k in range(99) if zlib.crc32(str(k).encode()) % 4 != 2), 2: next(str(k) for k in range(99) if zlib.crc32(str(k).encode()) % 4 == 2)}
    rows = s.findings(turned.withColumn("doc_id", F.when(F.col("key") == 0, other[0]).otherwise(other[2]))).distinct().collect()
    score = net.scores([tuple(r)[:3] for r in rows])
    label = np.array([r.label for r in rows])
    over = np.array([x >= net.thresholds[s.shape(r.body)] for x, r in zip(score, rows)])
    assert label.sum() >= 20
    assert over[label == 1].mean() >= 0.95 and over[label == 0].mean() <= 0.01


def test_finds_what_rules_miss(spark, net):
    texts = [f"the auth key = {KEY} of the", f"Bearer {KEY}", "an ordinary sentence of long words: internationalization", f"token = {KEY}", "call 2669109448945250 or write to someone.else@mail9.example.com"]
    rows = s.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), net).orderBy("doc_id").collect()
    begin = texts[0].index(KEY)
    assert rows[0].spans == f"net:{begin}:{begin + len(KEY)}" and rows[1].n_added == 1
    assert (rows[2].spans, rows[4].spans) == ("", "")
    assert (rows[3].n_assign, rows[3].n_added) == (1, 0)


def test_odd_rows(spark, net):
    texts = [None, "", "😀é token: 'abcdefgh😀'", "x" * 300_000 + " " + KEY, KEY, KEY]
    df = spark.createDataFrame([(None if k == 4 else 3, t, "z") for k, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(1)
    found, name = s.scan(df, net)
    assert found.columns == ["doc_id", "text", "spans", name] and name == "spans_"
    got = [[(x.kind, x.begin, x.end) for x in r[name]] for r in found.collect()]
    assert len(got) == 6 and got[:2] == [[], []]
    by_text = {(r.text or "")[:9]: [(x.kind, x.begin, x.end) for x in r[name]] for r in found.collect()}
    assert by_text["😀é token:"] == [("assign", 3, 19)]
    assert ("net", 300_001, 300_001 + len(KEY)) in by_text["x" * 9]
    assert s.digests(df.limit(0), net).count() == 0


def test_without_labels(spark):
    empty = s.fit(spark.createDataFrame([], "before string, body string, after string, label int"))
    assert empty.thresholds is None
    got = s.digests(spark.createDataFrame([(1, f"x {KEY} token=abcdefgh")], "doc_id long, text string"), empty).first()
    assert (got.n_assign, got.n_added) == (1, 0)
    one = s.fit(spark.createDataFrame([("a", "b" * 20, "c", 1), ("a", None, "c", 0), ("a", "b", "c", None)], "before string, body string, after string, label int"))
    assert one.thresholds is None


def test_repeated_findings_count_once(spark):
    rows = [("key ", KEY, "", 1)] + [("", f"word{k:04d}internationally", " ", 0) for k in range(60)] + [("key ", KEY[k:] + KEY[:k], "", 1) for k in range(1, 30)]
    df = spark.createDataFrame(rows, "before string, body string, after string, label int")
    once, often = s.fit(df), s.fit(df.union(df.limit(1).crossJoin(spark.range(5000)).drop("id")))
    assert once.thresholds == often.thresholds and all((once.weights[k] == often.weights[k]).all() for k in once.weights)


def test_gradients():
    net = s.Network(1)
    windows, labels = [('token = "', "a1b2c3d4e5f6a7b8c9d0", '" x'), ("", "wordwordwordwordword", " é"), ("ab", "zz9zz9zz", ""), ("ñññ", "x" * 50, "yyyyyyyy")], np.array([1, 0, 1, 0])
    loss, slopes = net.gradients(windows, labels)
    chance = 1 / (1 + np.exp(-net.logits(windows)))
    assert loss == pytest.approx(-np.mean(np.where(labels > 0, np.log(chance), np.log(1 - chance))), abs=1e-5)
    net.weights = {k: v.astype(float) for k, v in net.weights.items()}
    for k, v in net.weights.items():
        at, step = np.unravel_index(np.abs(slopes[k]).argmax(), v.shape), 1e-5
        v[at] += step
        above = net.gradients(windows, labels)[0]
        v[at] -= 2 * step
        assert (above - net.gradients(windows, labels)[0]) / (2 * step) == pytest.approx(slopes[k][at], rel=0.02, abs=1e-5)
        v[at] += step


def test_stretches_change_nothing(monkeypatch):
    net, rng = s.Network(2), random.Random(3)
    windows = [tuple("".join(rng.choices("abcXYZ019 é", k=rng.choice(sizes))) for sizes in ((0, 5, 24), (8, 40, 900), (0, 8))) for _ in range(40)]
    whole = net.logits(windows)
    monkeypatch.setattr(s, "CELLS", 61)
    assert np.allclose(net.logits(windows), whole, atol=1e-5)
    assert np.allclose(np.concatenate([net.logits([w]) for w in windows]), whole, atol=1e-5)


def test_thresholds_keep_recall(net, spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    rows = [r for r in s.findings(docs).distinct().collect() if r.label]
    score = net.scores([tuple(r)[:3] for r in rows])
    assert np.mean([x >= net.thresholds[s.shape(r.body)] for x, r in zip(score, rows)]) >= 0.97


def test_all_findings_count(spark):
    """Findings whose hashes come late, beyond any number of others, are learned from and calibrate."""
    rng = random.Random(5)
    draw = lambda alphabet: "".join(rng.choices(alphabet, k=rng.randint(20, 40)))
    rows = [("key ", "Zz" + draw("abcXYZ0189"), "", 1, False) for _ in range(5000)] + [("key ", draw("0123456789abcdef"), "", 1, True) for _ in range(5000)]
    df = spark.createDataFrame([*rows, *[("", f"word{k:04d}internationally", " ", 0, None) for k in range(60)]], "before string, body string, after string, label int, late boolean")
    df = df.where("late is null or late = (xxhash64(before, body, after) >= 0)").drop("late")
    net = s.fit(df)
    assert net.thresholds["hex"] != net.thresholds["mixed"]
    late = [tuple(r)[:3] for r in df.where("label = 1").collect() if s.shape(r.body) == "hex"]
    assert len(late) > 2000 and np.mean(net.scores(late) >= net.thresholds["hex"]) >= 0.97


def test_shards(spark):
    """Every finding is dealt; each shard has findings of a rare label, and learns from long bodies."""
    rows = [("", f"word{k:05d}", "", 0) for k in range(3000)] + [("key ", KEY * k, "", 1) for k in range(1, 41)]
    df = spark.createDataFrame(rows, "before string, body string, after string, label int").withColumn("key", F.xxhash64("before", "body", "after"))
    got = s.dealt(df, {0: 3000, 1: 40}, 5)
    assert got.where("label = 0").count() == 3000 and got.select("body").distinct().count() == 3040
    assert {r[0]: r[1] for r in got.where("label = 1").groupBy("shard").count().collect()} == dict.fromkeys(range(5), 40)
    net = s.fit(df.where("label = 0 or length(body) > 128"))
    assert net.thresholds and np.mean(net.scores([("key ", KEY * k, "") for k in range(5, 41)]) >= net.thresholds["mixed"]) >= 0.9


def test_gradients_in_stretches(monkeypatch):
    net, rng = s.Network(2), random.Random(3)
    windows = [tuple("".join(rng.choices("abcXYZ019 é", k=rng.choice(sizes))) for sizes in ((0, 5, 24), (8, 40, 900), (0, 8))) for _ in range(40)]
    labels = np.arange(40) % 2
    whole = net.gradients(windows, labels)
    monkeypatch.setattr(s, "CELLS", 61)
    cut = net.gradients(windows, labels)
    assert cut[0] == pytest.approx(whole[0], abs=1e-5) and all(np.allclose(cut[1][k], whole[1][k], atol=1e-5) for k in whole[1])
