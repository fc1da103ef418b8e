"""License scans against plain Python."""

import math
import random
import re
import time

from roadspark.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    low = (text or "").translate({k: k + 32 for k in range(65, 91)})
    w, places, base = WORD.findall(low), [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                base.add(label)
    labels, score = set(base), 0.0
    for line in low.split("\n"):
        have = set(WORD.findall(line))
        for label, template in licenses.TEMPLATES:
            t = set(template.split())
            if len(have & t) >= math.ceil(licenses.CONTAINED * len(t) - 1e-9):
                labels.add(label)
                score = max(score, len(have & t) / len(t))
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


def test_lines_against_plain_python(spark):
    rnd = random.Random(5)
    texts = [None, "", "mit license", "MIT  License-mit license cc by CC-BY cc by", "mit\nlicense", "the permit license", "émit license", "Kmit license", "mit licenseé"]
    for _, template in licenses.TEMPLATES:
        words = template.split()
        for drop in (0, 1, 2, 3):
            some = [w.upper() if rnd.random() < 0.5 else w for w in rnd.sample(words, max(0, len(words) - drop))]
            texts += [", ".join(some), "pad line\n" + " ".join(some) + " more words " * rnd.randint(0, 9) + "\nend", "\n".join(some)]
    texts.append("word " * 100_000 + "\nreleased under the mit license")
    docs = spark.createDataFrame([(rnd.choice([k, None, 1]), t, k) for k, t in enumerate(texts)] * 2, "doc_id long, text string, labels int")
    got = sorted((str(tuple(r)[1:]) for r in licenses.scan(docs, wrapped=False).collect()))
    assert got == sorted(str(plain(t)) for t in texts * 2)


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_in_the_plan(spark):
    for wrapped in (True, False):
        plan = licenses.scan(spark.createDataFrame([(1, "mit license")], "doc_id long, text string"), wrapped=wrapped)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|MapInArrow", plan)


def plain_wrapped(text):
    """Labels and score when every run of words is a block."""
    w = WORD.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))
    labels, score = set(plain(" ".join(w))[4].split(",")) - {""}, 0.0
    for label, template in licenses.TEMPLATES:
        t, span = set(template.split()), licenses.SPAN * len(template.split())
        for k in range(max(1, len(w) - span + 1)):
            common = len(t & set(w[k : k + span]))
            if common >= math.ceil(licenses.CONTAINED * len(t) - 1e-9):
                labels.add(label)
                score = max(score, common / len(t))
    return ",".join(sorted(labels)), score


def test_wrapped_notices(spark):
    rnd = random.Random(6)
    notices = ["Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files", "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are\n# met:", "GNU General\nPublic License, version 3", "All rights\nreserved."]
    scattered = "all " + "pad " * 30 + "rights " + "pad " * 30 + "reserved"
    texts = [None, "", *notices, scattered, "word " * 5000 + notices[0] + " word" * 5000]
    for _, template in licenses.TEMPLATES:
        words = template.split()
        for drop in (0, 1, 2, 3):
            some = [x for w in rnd.sample(words, max(0, len(words) - drop)) for x in [w] + ["pad"] * rnd.choice([0, 0, 1, 2, 3])]
            texts += ["\n".join(some), "pad " * rnd.randint(0, 80) + "\r\n * ".join(some).upper() + "\nend" * rnd.randint(0, 80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs).collect()}
    assert got == {k: plain_wrapped(t) for k, t in enumerate(texts)}
    assert [got[k][0] for k in range(2, 8)] == ["mit", "bsd", "gpl", "reserved", "", "mit"]
    # Each row of a table of repeated rows has the same.
    again = licenses.scan(docs.union(docs.limit(60)).union(docs.where("doc_id < 9"))).collect()
    assert len(again) == len(texts) + 60 + 9 and all((r.labels, r.score) == got[r.doc_id] for r in again)


def test_other_thresholds_and_phrases(spark, monkeypatch):
    """Long prefixes, small templates, phrases with a word twice, against plain counting."""
    rnd = random.Random(8)
    templates = [("a", "w1 w2 w3 w4 w5 w6 w7 w8"), ("b", "w1 w9"), ("c", "w3"), ("d", "w2 w2 w4 w4 w11")]
    phrases = [("w1 w2 w1", "p"), ("w4", "q"), ("w5 w6", "r")]
    texts = [" ".join(rnd.choices([f"w{k}" for k in range(14)], k=rnd.choice([1, 3, 9, 40, 200]))) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(licenses, "PHRASES", phrases)
    monkeypatch.setattr(licenses, "TEMPLATES", templates)
    for contained in (0.5, 0.75, 1.0):
        monkeypatch.setattr(licenses, "CONTAINED", contained)
        got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in licenses.scan(docs, templates=templates, phrases=phrases, contained=contained).collect()}
        assert got == {k: (*plain(t)[:5], *plain_wrapped(t)) for k, t in enumerate(texts)}
    assert licenses.scan(docs, templates=[], phrases=[]).where("n_base > 0 or labels <> ''").count() == 0


def test_a_very_long_text_of_one_notice(spark):
    """Some hundred thousand places of a notice in one text take seconds, not minutes."""
    notice = "released under the mit license\n"
    docs = spark.createDataFrame([(1, notice * 100_000), (2, "word " * 10 + notice)], "doc_id long, text string")
    began = time.time()
    rows = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert time.time() - began < 40
    assert (rows[1].n_words, rows[1].n_base, rows[1].last_word, rows[1].labels, rows[1].score) == (500_000, 100_000, 499_998, "mit", 1.0)
    assert (rows[2].first_word, rows[2].labels) == (13, "mit")


def test_filters_leave_only_what_can_match(spark):
    """Places that go into the count: none of texts with scattered or too few words."""
    scattered = "permission " + "pad " * 200 + "granted " + "pad " * 200 + "obtaining"
    few = "permission is hereby granted"
    docs = spark.createDataFrame([(1, scattered), (2, few), (3, licenses.TEMPLATES[5][1])], "doc_id long, text string")
    places, counts = licenses.places_of_interest(docs.withColumnRenamed("doc_id", "k"), ["k"], "text", licenses.TEMPLATES, licenses.PHRASES, licenses.CONTAINED)
    found = licenses.wrapped_matches(places, counts, ["k"]).collect()
    assert {(r.k, r.label, r.containment) for r in found} == {(3, "mit", 1.0)}
