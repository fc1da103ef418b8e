"""Decontamination against plain Python: hits, items, verdicts, longest matches, blocks."""

import hashlib
import random
import re

import pytest

from roadspark.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))


def plain(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, found, longest = words(text), set(), set(), 0
        for item_id, item in items:
            v = words(item)
            m = min(13, len(v))
            for j in range(len(v) - m + 1 if v else 0):
                for i in range(len(w) - m + 1):
                    if w[i : i + m] == v[j : j + m]:
                        hit.update(range(i, i + m))
                        found.add("null" if item_id is None else str(item_id))
                        n = m
                        while i + n < len(w) and j + n < len(v) and w[i + n] == v[j + n]:
                            n += 1
                        longest = max(longest, n)
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w), longest))
    return sorted(out, key=str)


def case(seed):
    rnd = random.Random(seed)
    vocabulary = ["a", "B", "cé", "d1", "e", "ſ"]
    text = lambda n: " ".join(rnd.choice(vocabulary) + rnd.choice(["", ",", "\n"]) for _ in range(n))
    items = [(k, text(rnd.choice([1, 2, 12, 13, 14, 30]))) for k in range(12)] + [(3, text(20)), (None, text(15)), (99, None), (98, " ..")]
    docs = []
    for k in range(60):
        body = text(rnd.randint(0, 60))
        if rnd.random() < 0.6:
            body += " " + (rnd.choice(items)[1] or "") + " " + text(rnd.randint(0, 300))
        docs.append((rnd.choice([k, None, 5]), rnd.choice([body, body.upper(), None if k % 17 == 0 else body])))
    return docs, items


def run(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in decontam.verdicts(d, b, **options).collect()), key=str)


def test_against_plain_python(spark):
    for seed in (1, 2):
        docs, items = case(seed)
        expected = plain(docs, items)
        assert run(spark, docs, items) == expected
        assert run(spark, docs, items, block_bytes=200) == expected  # several passes


def test_long_windows_and_longest_match(spark):
    passage = " ".join(f"w{k}" for k in range(40))
    docs = [(1, "x y " + passage + " z"), (2, "x " * 50_000 + passage), (3, "w0 w1 w2")]
    assert run(spark, docs, [(7, passage)]) == plain(docs, [(7, passage)])


def test_filter_keeps_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 2), (2, "q r s t u v w x y z 1 2 3", 3)], "doc_id long, text string, contamination int")
    items = spark.createDataFrame([(1, "q r s t u v w x y z 1 2 3")], "item_id long, text string")
    kept = decontam.decontaminate(docs, items)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, "a b", 2)]
    assert decontam.decontaminate(docs.limit(0), items).count() == 0
    assert decontam.decontaminate(docs, items.limit(0)).count() == 2


def test_the_index_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(decontam, "INDEX_BYTES", 1000)
    items = [(k, " ".join(f"w{j}" for j in range(k, k + 20))) for k in range(30)]
    with pytest.raises(ValueError, match="index"):
        run(spark, [(1, "w1 w2")], items)
    assert run(spark, [(1, items[3][1])], items[:2], block_bytes=100) == plain([(1, items[3][1])], items[:2])


def test_null_and_the_word_null_are_one_item(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "a b c"), ("null", "d e f")], "item_id string, text string")
    assert {(r.doc_id, r.n_items, r.items_sha256) for r in decontam.verdicts(docs, items).collect()} == {(k, 1, hashlib.sha256(b"null").hexdigest()) for k in (1, 2)}


def test_longest_match_of_every_item(spark):
    """Lengths as by trying all places; the place given holds such a match."""
    for seed in (3, 4):
        docs, items = case(seed)
        docs, items = docs[:25], items + [(97, "nowhere at all"), (96, "zz e zz")]
        expected = {}
        for item_id, item in items:
            v, most = words(item), 0
            for _, text in docs:
                w, above = words(text), {}
                for x in w:
                    above = {j: above.get(j - 1, 0) + 1 for j in range(len(v)) if v[j] == x}
                    most = max(most, *above.values(), 0)
            name = "null" if item_id is None else str(item_id)
            expected[name] = max(most, expected.get(name, 0))
        d = spark.createDataFrame(docs, "doc_id long, text string")
        b = spark.createDataFrame(items, "item_id long, text string")
        for options in ({}, {"block_bytes": 200}):
            rows = decontam.item_matches(d, b, **options).collect()
            assert {r.item_id: r.length for r in rows} == expected and len(rows) == len(expected)
            for r in rows:
                if r.length:
                    have = {tuple(words(t)[r.doc_start : r.doc_start + r.length]) for k, t in docs if k == r.doc_id}
                    want = {tuple(words(t)[r.item_start : r.item_start + r.length]) for k, t in items if ("null" if k is None else str(k)) == r.item_id}
                    assert any(len(x) == r.length for x in have & want)
                else:
                    assert r.item_start is None and r.doc_id is None and r.doc_start is None
    assert {r.length for r in decontam.item_matches(d.limit(0), b).collect()} == {0}
    assert decontam.item_matches(d, b.limit(0)).count() == 0
