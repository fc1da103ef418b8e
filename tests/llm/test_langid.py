"""Language ID: automaton against brute force, held-out accuracy, odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadspark.llm import langid
from roadspark.llm.common import held_out, table


def greedy(sample: bytes, text: bytes) -> int:
    """Phrases of a cross-parse, by plain search."""
    count = at = 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at : at + size] in sample:
            size += 1
        at += max(1, size - 1)
        count += 1
    return count


def test_phrases_equal_brute_force(monkeypatch):
    rnd = random.Random(3)
    word = lambda n: "".join(rnd.choice("abc ") for _ in range(n))
    samples = {"x": langid.symbols(word(300)), "y": langid.symbols(word(200) + "ddd")}
    model = langid.Model(samples)
    texts = [langid.symbols(word(rnd.randint(1, 900)) + rnd.choice(["", "d", "éq"])) for _ in range(40)]
    unknown = "éqé"
    texts += [langid.symbols("".join(rnd.choice("abd" + unknown) for _ in range(n))) for n in (1, 2, 3, 9, 600, 2100)] + [langid.symbols("q"), langid.symbols("éé"), langid.symbols("ab" * 1500)]
    expected = [[greedy(samples[k].tobytes(), t.tobytes()) for k in model.languages] for t in texts]
    assert model.phrases(texts).tolist() == expected
    for segment in (1, 2, 7):  # whatever the cuts, side by side or one by one
        for few in (0, 3, 10_000):
            monkeypatch.setattr(langid, "SEGMENT", segment)
            monkeypatch.setattr(langid, "FEW", few)
            assert model.phrases(texts).tolist() == expected


def brute_force(samples, texts):
    """Language and score of each text from plain phrase counts."""
    out = []
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        t = langid.symbols(text).tobytes()
        cost = {k: greedy(v.tobytes(), t) * np.log2(len(v) + 2) / max(1, len(t)) for k, v in samples.items()}
        best = min(sorted(cost), key=cost.get)
        out.append((best, 1 / sum(np.exp(-langid.SHARPNESS * (c - cost[best])) for c in cost.values())))
    return out


def test_predictions_equal_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = langid.train(docs)
    # The samples, chosen plainly: of each language the different texts with the smallest hashes.
    rows = docs.where("lang is not null and text is not null and crc32(cast(string(doc_id) as binary)) % 4 <> 2").selectExpr("lang", "text", "xxhash64(text) as h").distinct().collect()
    samples = {}
    for lang in {r.lang for r in rows}:
        first = sorted((r.h, r.text) for r in rows if r.lang == lang and any(c.isalpha() for c in r.text))[: langid.TEXTS]
        share = -(-2 * langid.SAMPLE // len(first))
        parts = spark.createDataFrame(first, "h long, t string").selectExpr("h", f"substring(t, int(1 + pmod(xxhash64(h), greatest(1, length(t) - {share} + 1))), {share}) as p").orderBy("h").collect()
        samples[lang] = np.concatenate([langid.symbols(r.p + " ")[: -(-langid.SAMPLE // len(first))] for r in parts])[: langid.SAMPLE]
    assert model.languages == sorted(samples)
    found, lang, score = langid.predict(docs, model)
    got = sorted(((r.text or ""), r[lang], r[score]) for r in found.collect() if len(r.text or "") < 3000)
    expected = brute_force(samples, [t for t, *_ in got])
    assert [(g[1], pytest.approx(g[2], abs=1e-9)) for g in got] == expected


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found, lang, score = langid.predict(docs, langid.train(docs))
    rows = found.where(held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select("lang", lang, score).collect()
    assert np.mean([r[0] == r[1] for r in rows]) > 0.98
    assert all(0 <= r[2] <= 1 for r in rows)


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog " * 20, "en"), (3, "der hund und die katze " * 20, "de"), (4, None, "en"), (4, None, None), (None, "hund und katze", None), (5, "", "de"), (6, "123 !!", "en"), (7, "the dog " * 30000, None)]
    docs = spark.createDataFrame([(*r, "z", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    found, lang, score = langid.predict(docs, langid.train(docs, learnable=F.lit(True)))
    got = [(r.doc_id, r[lang]) for r in found.collect()]
    assert sorted(got, key=str) == sorted([(1, "en"), (3, "de"), (4, "und"), (4, "und"), (None, "de"), (5, "und"), (6, "und"), (7, "en")], key=str)
    assert (lang, score) == ("lang_pred_", "score_")
    kept = langid.accepted(docs, langid.train(docs, learnable=F.lit(True)))
    assert kept.columns == docs.columns and kept.count() == 4
    none = docs.limit(0)
    assert langid.predict(none, langid.train(none))[0].count() == 0
    assert {r[0] for r in langid.predict(docs, langid.train(none))[0].select("lang_pred_").collect()} == {"und"}


def test_what_is_no_known_language_goes(spark):
    rows = [(k, "the cat and the dog sat on a mat " * 3 + str(k), "en") for k in range(20)] + [(50, "это совсем другой язык и письмо", None), (51, "a", None), (52, "dog", None), (53, "12", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in langid.accepted(docs, langid.train(docs, learnable=F.lit(True))).collect()}
    assert kept == {*range(20), 51, 52}


def test_bounded_training(spark, monkeypatch):
    """Rows that repeat count once, each row gives its share, and more languages than the bound are an error."""
    rows = [(1, "the dog " * 50_000, "en")] * 300 + [(k, f"a cat number {k} sat on the mat", "en") for k in range(2, 40)] + [(99, "der hund und die katze " * 20, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, learnable=F.lit(True))
    assert model.languages == ["de", "en"] and model.predict(["a cat sat on the mat", "die katze"])[0] == ["en", "de"]
    assert model.languages == ["de", "en"]
    monkeypatch.setattr(langid, "LANGUAGES", 1)
    with pytest.raises(ValueError, match="languages"):
        langid.train(docs, learnable=F.lit(True))


def test_no_language_is_lost(spark):
    """One row repeated very often, texts without letters, a text whose letters come late."""
    often = spark.range(200_000).selectExpr("1L as doc_id", "'the same dog again and again' as text", "'en' as lang")
    rows = [(k, f"a cat number {k} sat on the mat", "en") for k in range(2, 60)] + [(99, "der hund und die katze " * 20, "de"), (100, "12345 " * 20, "xx"), (101, "1 " * 100_000 + "ñandú niño", "es"), (102, None, "yy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").unionByName(often)
    model = langid.train(docs, learnable=F.lit(True))
    assert model.languages == ["de", "en", "es"]
    assert model.predict(["a cat sat on the mat", "die katze", "el niño"])[0] == ["en", "de", "es"]
