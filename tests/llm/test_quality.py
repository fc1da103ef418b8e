"""Quality scores: held-out ranking, the cut, odd rows."""

import collections
import math
import re

import numpy as np
from pyspark.sql import functions as F

from roadspark.llm import quality
from roadspark.llm.common import held_out, table
from roadspark.llm.words import SPACED, mix, split_words

SF = "/root/testdata/sf0.01"


def test_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scored, name = quality.score(docs, quality.train(docs, labels))
    rows = scored.join(labels, "doc_id").where(held_out(F.col("doc_id"))).select(name, "quality").collect()
    s, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    better = (s[y == 1][:, None] > s[y == 0][None]).mean()
    assert better > 0.97
    assert (s[y == 1] >= quality.CUT).mean() > 0.95


def test_features_do_not_depend_on_neighbours():
    texts = ["", "one two  one", "é é | é!!", "x", "", "A B\nA B\n", " "]
    data = [t.encode() for t in texts]
    all_at = np.append(0, np.cumsum([len(d) for d in data]))
    together = quality.features(np.frombuffer(b"".join(data), np.uint8), all_at)
    for k, d in enumerate(data):
        alone = quality.features(np.frombuffer(d, np.uint8), np.array([0, len(d)]))
        assert np.allclose(together[k], alone[0])


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "good text here", 9), (1, "good text here", 9), (2, None, 9), (None, "", 9), (3, "bad|bad|bad " * 60_000, 9)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (3, 0), (2, None), (None, 1), (5, 1), (5, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels, learnable=F.lit(True))
    scored, name = quality.score(docs, model)
    assert name == "score_" and scored.count() == 5
    found = {r.doc_id: r[name] for r in scored.collect()}
    assert found[1] > found[3] and all(0 <= v <= 1 for v in found.values())
    assert quality.accepted(docs, model).columns == docs.columns
    assert quality.score(docs.limit(0), model)[0].count() == 0
    blank = quality.train(docs, labels.limit(0))
    assert {r[name] for r in quality.score(docs, blank)[0].collect()} == {0.5}


def plain_features(text):
    """The features of a text, one by one."""
    data = text.encode()
    n = max(1, len(data))
    share = lambda wanted: sum(data.count(bytes([b])) for b in wanted) / n
    marks = [chr(k) for k in range(33, 127) if not chr(k).isalnum()]
    low = "".join(c.lower() if c.isascii() else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    pairs = list(zip(words, words[1:]))
    some = max(1, len(words))
    most = lambda items: max(collections.Counter(items).values(), default=0)
    return [
        *[math.sqrt(share(m.encode())) for m in marks],
        math.sqrt(share(range(65, 91))),
        math.sqrt(share(range(48, 58))),
        share(range(97, 123)),
        share(b"\t\n\r "),
        share(range(128, 256)),
        math.log1p(len(words)),
        math.log1p(len(data) / some),
        len(set(words)) / some,
        most(words) / some,
        len(set(pairs)) / max(1, len(pairs)),
        most(pairs) / max(1, len(pairs)),
        math.log1p(some / (text.count("\n") + 1)),
        float(not words),
        float(len(words) < 5),
    ]


def test_features_equal_plain_ones(spark):
    texts = ["", " ", "one", "One two  one\ttwo one two", "é é | é!!", "a\n\nb\r\nc 12.5%", "x" * 999, *[r.text or "" for r in table(spark, SF, "documents").limit(150).collect()]]
    data = [t.encode() for t in texts]
    got = quality.features(np.frombuffer(b"".join(data), np.uint8), np.append(0, np.cumsum([len(d) for d in data])))
    assert np.allclose(got, [plain_features(t) for t in texts])


def test_fit_minimises_the_pairwise_loss():
    """Against plain gradient descent over all pairs, and every quantile as a cut."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 4)) * [1, 5, 0.1, 2] + [0, 3, 1, -2]
    y = (x @ [0.8, -0.3, 2.0, 0.0] + rng.normal(size=120) > np.median(x @ [0.8, -0.3, 2.0, 0.0])).astype(int)
    model = quality.fit(x, y)
    z = np.clip((x - x.mean(0)) / (x.std(0) + 1e-6), -8, 8)
    pairs = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, 4)
    loss = lambda w: np.log1p(np.exp(-pairs @ w)).mean() + 0.5e-4 * (w**2).sum()
    w = np.zeros(4)
    for _ in range(4000):
        w += 0.3 * ((pairs / (1 + np.exp(pairs @ w))[:, None]).mean(0) - 1e-4 * w)
    assert loss(model["weights"]) <= loss(w) + 0.003
    s = z @ model["weights"]
    gain = lambda cut: (s[y == 0] < cut).mean() - (s[y == 1] < cut).mean()
    assert gain(model["cut"]) >= max(gain(c) for c in s) - quality.SLACK - 1e-9
    assert np.allclose(quality.scores(model, x) >= quality.CUT, s >= model["cut"])


def test_repeated_rows_and_ties(spark):
    """A repeated id is learned from once; equal texts score alike, wherever they stand."""
    docs = spark.createDataFrame([(1, "good text here")] * 500 + [(3, "bad|bad|bad"), (4, "good text here")], "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 1)], "doc_id long, quality int")
    once = quality.train(docs.dropDuplicates(), labels, learnable=F.lit(True))
    model = quality.train(docs, labels, learnable=F.lit(True))
    assert all(np.allclose(model[k], once[k]) for k in model)
    scored, name = quality.score(docs, model)
    assert scored.groupBy("text").agg(F.count_distinct(name).alias("n")).where("n > 1").count() == 0


def test_content_equals_a_plain_count():
    """Shares of words, word pairs and byte runs in hash buckets, one by one."""
    texts = ["", "ab", "one two one two", "A\tB", "é!é!é!", "xyz", "One TWO"]
    data = [t.encode() for t in texts]
    flat, at = np.frombuffer(b"".join(data), np.uint8), np.append(0, np.cumsum([len(d) for d in data]))
    got = quality.content(flat, at, *split_words(flat, at, SPACED), 8)
    bucket = lambda v: int(mix(np.array([v % 2**64], np.uint64))[0] % np.uint64(8))
    for row, d in zip(got, data):
        low = d.lower()
        words = [int(w) for w in split_words(np.frombuffer(d, np.uint8), np.array([0, len(d)]), SPACED)[0]]
        assert len(words) == len(low.split())
        seen = [words, [3 * a + b for a, b in zip(words, words[1:])], [int.from_bytes(low[k : k + 3], "big") for k in range(len(low) - 2)]]
        expected = np.zeros((3, 8))
        for k, values in enumerate(seen):
            for v in values:
                expected[k, bucket(v)] += 1 / len(values)
        assert np.allclose(row, np.sqrt(expected).reshape(-1), atol=1e-6)


def test_content_tells_texts_of_one_shape_apart(spark):
    """Words alone decide: all texts have the same letters in the same numbers."""
    docs = [(k, " ".join((["stale", "tones"] if k % 2 else ["least", "onset"])[(k >> j) & 1] for j in range(1, 9))) for k in range(400)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in docs[:300]], "doc_id long, quality int")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    scored, name = quality.score(docs, quality.train(docs, labels, learnable=F.lit(True)))
    found = [(r.doc_id % 2, r[name]) for r in scored.where("doc_id >= 300").collect()]
    assert min(s for y, s in found if y) > max(s for y, s in found if not y)
