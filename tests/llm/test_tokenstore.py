"""Token store: random access, exact ids, starts, odd texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roadspark.llm import tokenstore

PATH = public_tokenizers.path("byte_bpe_50k.json")
ENCODER, PLAIN = tokenstore.WordEncoder(PATH), Tokenizer.from_file(PATH)
ODD = ["  a  b\n c ", "", " ", "x \n\ny\t z  ", "a b", "é ü  —x 1 2's don't", "<|endoftext|> a <|endoftext|>b", "a　b 　 c", "a\0b c", "a \0 b", " \n", "a \n b", "x y", "a. b.c ,d _. 3.14, ..", "w, " * 3000, None]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**22), max_size=700), max_size=6), st.sampled_from([4, 8, 12]))
def test_codes(lists, width):
    sizes = np.array([len(x) for x in lists], np.int64)
    levels = tokenstore.pack(np.array([i for x in lists for i in x], np.uint32), sizes, width)
    ids, back = tokenstore.unpack(levels, width)
    assert back.tolist() == sizes.tolist() and ids.tolist() == [i for x in lists for i in x]
    for one, own in zip(levels.to_pylist(), lists):
        for at in range(0, len(own), 97):
            assert tokenstore.token_at(one, at, width) == own[at]
        with pytest.raises(IndexError):
            tokenstore.token_at(one, len(own), width)
        places = np.array([-1, *range(len(own)), len(own), 10**9])
        assert tokenstore.tokens_at(one, places, width).tolist() == [-1, *own, -1, -1]


def encode(encoder, texts):
    data = [t.encode() for t in texts]
    bounds = np.append(0, np.cumsum([len(d) for d in data])).astype(np.int64)
    ids, sizes = encoder.encode(np.frombuffer(b"".join(data), np.uint8), bounds, 0)
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"aB .,\n\t'’é1_-　x\0×÷Ã²ª\x85\xa0\u2009\x1c;s", "<|endoftext|>"]), max_size=60).map("".join), min_size=1, max_size=4))
def test_word_encoder_equals_library(texts):
    assert encode(ENCODER, texts) == [[*PLAIN.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def test_store(spark, tmp_path):
    rows = [(k * 7 % 16 if k < 14 else None, t) for k, t in enumerate(ODD)] + [(3, "again"), (3, "again")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, seq int").repartition(3)
    tokenstore.write_store(docs, str(tmp_path / "s"), PATH)
    store = tokenstore.open_store(spark, str(tmp_path / "s"))
    got = [tuple(r) for r in tokenstore.document_index(store).orderBy("start").collect()]
    plain, start, expected = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1] is not None, r[1] or "")):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == expected
    tokenstore.write_store(docs.limit(0), str(tmp_path / "e"), PATH)
    assert tokenstore.document_index(tokenstore.open_store(spark, str(tmp_path / "e"))).count() == 0


def test_a_hot_id_is_spread_and_the_cache_starts_anew(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenstore, "CACHED_PARTS", 20)
    rows = [(1, f"text {k % 50} of many {k % 3}") for k in range(400)] + [(0, "first"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or small ranges become one
    tokenstore.write_store(docs, str(tmp_path / "s"), PATH)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    store = tokenstore.open_store(spark, str(tmp_path / "s"))
    assert store.select("part").distinct().count() > 1
    got = tokenstore.document_index(store).orderBy("start").collect()
    assert [r.doc_id for r in got] == [0, *[1] * 400, 2]
    plain = Tokenizer.from_file(PATH)
    crc = lambda t: zlib.crc32(np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes())
    assert sorted(r.ids_crc32 for r in got) == sorted(crc(t) for _, t in rows)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]


def test_lookup(spark, tmp_path):
    """Random access of a table of places, held against plain encoding."""
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "null id"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tokenstore.write_store(docs, str(tmp_path / "s"), PATH)
    plain = Tokenizer.from_file(PATH)
    ids = [(k, [*plain.encode(t or "", add_special_tokens=False).ids, 0]) for k, t in rows]
    wanted = [(k, at) for k in range(len(ODD)) for at in (0, 1, 2, 5, 100, 5999, 6000, 6001, -1)] + [(0, 0), (99, 0), (None, 0), (1, None)]
    got = tokenstore.lookup(tokenstore.open_store(spark, str(tmp_path / "s")), spark.createDataFrame([(*w, 1) for w in wanted], "doc_id long, at long, token int"))
    expected = []
    for k, at in set(wanted):
        own = [x[at] if at is not None and 0 <= at < len(x) else None for i, x in ids if i == k and k is not None and at is not None]
        expected += [(k, at, t) for t in own or [None]]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))
    assert tokenstore.lookup(tokenstore.open_store(spark, str(tmp_path / "s")), spark.createDataFrame([], "doc_id long, at long")).count() == 0
