"""Lexical search: every score against a plain count, ties, odd rows, shards and blocks."""

import math
import random
import re
from collections import Counter

import pytest

from roadspark.llm import lexical
from roadspark.llm.common import table


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=10):
    held = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in held:
            m = 100 - 75 + (75 * sum(c.values()) * len(held)) // total
            s = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text))
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(docs, items, **options):
    return sorted(map(tuple, lexical.search(docs, items, **options).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_documents(spark):
    docs, items = (table(spark, "/root/testdata/sf0.001", n) for n in ("documents", "benchmark"))
    plain = [tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()]
    assert found(docs, items) == brute(*plain)


@pytest.mark.parametrize("seed", range(3))
def test_ties_shards_and_blocks(spark, seed, monkeypatch):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["Ä", "the", "THE"]
    docs = [(k, " ".join(rng.choices(words, [1 / (1 + j) for j in range(43)], k=rng.choice([1, 5, 5, 5, 9, 30])))) for k in range(300)]
    docs += [(1000 + k, docs[7][1]) for k in range(100)]  # a hot group of copies: equal scores
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 3, 12])))) for k in range(12)]
    expected = brute(docs, items)
    frame = frames(spark, docs, items)
    assert found(*frame) == expected
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 60)
    assert found(frame[0].repartition(5), frame[1], block_bytes=60) == expected
    assert found(*frame, k=3) == brute(docs, items, 3)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "..."), (4, "red Fox"), (4, "red Fox"), (None, "red fox"), (5, "blue " * 5000), (6, "red\x00fox Blue")]
    items = [(1, None), (2, "--"), (3, "fox FOX blue"), (3, "fox FOX blue"), (None, "red"), (7, "absent")]
    once = [items[k] for k in (0, 1, 2, 4, 5)]
    d, i = frames(spark, docs, items)
    d, i = d.selectExpr("*", "1 as m", "'x' as TERMS", "2 as row"), i.selectExpr("*", "3 as number")
    assert found(d, i) == brute(docs, once)
    assert found(d.limit(0), i) == found(d, i.limit(0)) == []
    # Different texts under one id are items of their own.
    assert len(found(d, spark.createDataFrame([(1, "red"), (1, "blue")], "item_id long, text string"))) == 6


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "red"), ("a", "red"), ("c", "x y")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "red")], "item_id string, text string")
    assert [r[:3] for r in found(docs, items)] == [("q", 1, "a"), ("q", 2, "b")]


def test_bounds_hold_and_prune(monkeypatch):
    """No score passes its stratum's bound, and visits stop before the last stratum."""
    import numpy as np

    rng = np.random.default_rng(1)
    items = lexical.Items(["a b c", "c d"])
    items.weigh(1000, {k: 50 + k for k in range(4)})
    m = np.sort(rng.integers(25, 300, 400))
    doc = np.repeat(np.arange(400), 2)
    strata = lexical.Strata(m, doc, rng.permuted(np.tile(np.arange(4), (400, 1)), axis=1)[:, :2].ravel(), rng.integers(1, 9, 800))
    bounds = strata.bounds(items)
    for s in range(len(strata.values)):
        for item in range(2):
            assert strata.scores(items, item, s).max() <= bounds[s, item]
    visits = []
    plain = lexical.Strata.scores
    monkeypatch.setattr(lexical.Strata, "scores", lambda self, i, item, s: (visits.append((item, s)), plain(self, i, item, s))[1])
    got = strata.search(items, np.arange(400), 3, np.zeros(2, np.int64))
    every = [np.concatenate([plain(strata, items, item, s) for s in range(len(strata.values))]) for item in range(2)]
    assert [list(got[2][got[0] == item]) for item in range(2)] == [sorted(e, reverse=True)[:3] for e in every]
    assert len(visits) < len(strata.values)
