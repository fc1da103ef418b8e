"""License notices by an exact set-similarity join (op 6), in DataFrame operations only.

A text's blocks are runs of consecutive words, whatever its line breaks: for each template
every run of SPAN times as many words as the template has (or the whole text, if that is
shorter). So notices that are wrapped over lines are found, and words scattered over a long
line are none. A block matches a template when it holds at least CONTAINED of the template's
distinct words.

The join is exact. One pass over the texts notes where the words stand that any template or
phrase has; counts of these order each template's words, rarest in the corpus first. Then

- prefix: a match must hold one of a template's first (size - needed + 1) words, so only texts
  with such a word go on, and in them only what is within a run of one that passes the other two
  filters;
- length: within a run's reach of the word there must be as many template words as needed;
- position: a block's first common word, in that order, leaves only the words after it, so
  within reach there must be as many words from that place in the order on as needed.

What is left is counted exactly, without building any run: an occurrence of a word counts for
the runs that begin after the word's previous occurrence and at most a run's length before, so
the number of distinct words in a run is the number of such stretches that cover its begin, a
running sum over their ends. It takes the same few windows for a text of any length, and rows
as narrow as a place and a word.

With ``wrapped=False`` the blocks are lines instead: their first common word's places on both
sides and the line's size bound the overlap before it is counted.

Besides, base phrases are found wherever their words stand consecutively in the text.

Words are runs of ASCII letters (A-Z lower-cased), digits and non-ASCII characters. Null
text is empty and matches nothing. Repeated rows and null ids are judged row by row; an
empty table gives an empty table.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LETTERS, saved

CONTAINED = 0.9
#: Words of a run, for each word of the template: inserted words and comment marks have room.
SPAN = 2
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
TEMPLATES = [
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has dedicated all copyright to the public domain cc0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "all rights reserved"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
]


def spaced(text: Column) -> Column:
    """The words of a text, as they are written, with single spaces between."""
    return F.trim(F.regexp_replace(text, SEPARATORS, " "))


def word_list(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none for a text without words."""
    return F.array_remove(F.split(F.translate(spaced(text), LETTERS, LETTERS.lower()), " "), "")


def holds(text: Column, words: list[str]) -> Column:
    """A quick test: does one of the words stand in the text, in any case?"""
    return text.rlike(r"(?i)(?<![a-z0-9\x80-\x{10FFFF}])(?:" + "|".join(sorted(words)) + r")(?![a-z0-9\x80-\x{10FFFF}])") if words else F.lit(False)


def corpus_counts(texts: DataFrame, text_column: str, vocabulary: list[str]) -> dict[str, int]:
    """How often the corpus uses each template word: a row for each of them at most."""
    words = texts.select(F.explode(F.split(F.lower(F.col(text_column)), SEPARATORS)).alias("w"))
    return {r[0]: r[1] for r in words.where(F.col("w").isin(vocabulary)).groupBy("w").count().collect()}


def template_index(counts: dict[str, int], templates: list[tuple[str, str]], contained: float) -> list[tuple]:
    """For each template and word of its prefix: word, template, label, ordered words, needed, place."""
    rows = []
    for number, (label, text) in enumerate(templates):
        ordered = sorted(set(text.split()), key=lambda w: (counts.get(w, 0), w))
        needed = math.ceil(contained * len(ordered) - 1e-9)
        rows += [(w, number, label, ordered, needed, place) for place, w in enumerate(ordered[: len(ordered) - needed + 1])]
    return rows


def matches(docs: DataFrame, id_columns: list[str], text_column: str = "text", templates: list[tuple[str, str]] = TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """Every block that meets a template: id columns, block (line number), template, label, containment."""
    spark = docs.sparkSession
    vocabulary = sorted({w for _, text in templates for w in text.split()})
    counts = corpus_counts(docs, text_column, vocabulary)
    index = template_index(counts, templates, contained)
    schema = "word string, template int, label string, ordered array<string>, needed int, place int"
    by_word = F.broadcast(spark.createDataFrame(index, schema))  # a row for each prefix word of the template list
    rank = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    order = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, rank[w])])
    rare = sorted({r[0] for r in index})

    text = F.col(text_column)
    lines = docs.where(holds(text, rare)).select(*id_columns, F.posexplode(F.split(text, "\n")).alias("block", "line")).where(holds(F.col("line"), rare))
    known = F.filter(F.array_distinct(word_list(F.col("line"))), lambda w: w.isin(vocabulary))
    blocks = lines.select(*id_columns, "block", F.transform(F.array_sort(F.transform(known, lambda w: F.struct(F.element_at(order, w).alias("rank"), w.alias("word")))), lambda x: x["word"]).alias("words"))
    keyed = blocks.select("*", F.posexplode("words").alias("at", "word"))
    met = keyed.join(by_word, "word").where(F.size("words") >= F.col("needed"))
    # The first common word bounds what can still be common on either side.
    met = met.where((F.size("ordered") - F.col("place") >= F.col("needed")) & (F.size("words") - F.col("at") >= F.col("needed")))
    # A pair meets at each common prefix word; it is counted at the first one alone.
    first = F.element_at(F.array_intersect("ordered", "words"), 1)
    common = F.size(F.array_intersect("words", "ordered"))
    return met.where(first == F.col("word")).withColumn("common", common).where("common >= needed").select(*id_columns, "block", "template", "label", (F.col("common") / F.size("ordered")).alias("containment"))


def vocabulary_places(docs: DataFrame, keys: list[str], text_column: str, vocabulary: list[str]) -> DataFrame:
    """keys, at, word: where the words of the vocabulary stand among the words of each text."""
    # The Kelvin sign is no ASCII letter, but its lower case is one.
    text = F.lower(F.replace(F.col(text_column), F.lit("\u212a"), F.lit("\u00e9")))
    begins_late = F.substring(text_column, 1, 1).rlike(SEPARATORS).cast("int")  # then the first word is an empty one
    rows = docs.where(F.col(text_column).isNotNull()).select(*keys, begins_late.alias("late"), F.posexplode(F.split(text, SEPARATORS)).alias("at", "word"))
    return rows.where(F.col("word").isin(vocabulary)).select(*keys, (F.col("at") - F.col("late")).alias("at"), "word")


def places_of_interest(docs: DataFrame, keys: list[str], text_column: str, templates: list[tuple[str, str]], phrases: list[tuple[str, str]], contained: float) -> tuple[DataFrame, dict[str, int]]:
    """keys, at, word of the texts that can hold a template or a phrase, each place once, and
    how often the corpus uses each word."""
    vocabulary = sorted({w for text in [*(t for _, t in templates), *(p for p, _ in phrases)] for w in text.split()})
    places = saved(vocabulary_places(docs, keys, text_column, vocabulary), "places")
    counts = {r[0]: r[1] for r in places.groupBy("word").count().collect()}  # a row for each word at most
    rare = {r[0] for r in template_index(counts, templates, contained)} | {min(p.split(), key=lambda w: (counts.get(w, 0), w)) for p, _ in phrases}
    texts = places.where(F.col("word").isin(sorted(rare))).select(*keys).distinct()
    return saved(places.join(texts, keys, "left_semi").distinct(), "places-kept"), counts


def wrapped_matches(places: DataFrame, counts: dict[str, int], keys: list[str], templates: list[tuple[str, str]] = TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """keys, template, label, containment: the best run of every text for every template that one
    of its runs meets. ``places`` has each place of a template word once; keys are not null."""
    if not templates:
        return places.limit(0).select(*keys, F.lit(0).alias("template"), F.lit("").alias("label"), F.lit(0.0).alias("containment"))
    spark = places.sparkSession
    index, longest = [], 1
    for number, (label, text) in enumerate(templates):
        ordered = sorted(set(text.split()), key=lambda w: (counts.get(w, 0), w))
        needed, span = math.ceil(contained * len(ordered) - 1e-9), SPAN * len(text.split())
        longest = max(longest, span)
        index += [(w, number, label, place, len(ordered), needed, span) for place, w in enumerate(ordered)]
    schema = "word string, template int, label string, place int, size int, needed int, span int"
    words = F.broadcast(spark.createDataFrame(index, schema))  # a row for each word of the template list
    prefix = words.where("place <= size - needed").select("word", "template")
    asked = places.join(F.broadcast(prefix), "word").select(*keys, "template").distinct()
    rows = places.join(asked, keys).join(words, ["word", "template"])

    # What is within a run's reach of a place is in its stretch of ``longest`` words or the next
    # ones: each row counts in three, so that counts of a stretch bound those of any place in it.
    group, stretch = [*keys, "template"], F.floor(F.col("at") / longest)
    rows = rows.withColumn("stretch", F.explode(F.array(stretch, stretch - 1, stretch + 1))).withColumn("own", F.col("stretch") == stretch)
    within = Window.partitionBy(*group, "stretch")
    prefixes = max(size - needed + 1 for *_, size, needed, _ in index)
    on = F.array(*[F.count_if(F.col("place") >= j).over(within) for j in range(prefixes)])
    rows = rows.withColumns({"near": F.count("*").over(within), "on": on})
    seed = F.col("own") & (F.col("place") <= F.col("size") - F.col("needed")) & (F.col("near") >= F.col("needed")) & (F.get("on", F.col("place")) >= F.col("needed"))
    rows = rows.withColumn("seed", F.coalesce(seed, F.lit(False))).withColumn("seed", F.max("seed").over(within)).where("seed")
    rows = rows.select(*group, "label", "size", "needed", "span", "word", "at").distinct()

    # A word's occurrence counts for the runs that begin in (its previous occurrence, itself].
    again = F.lag("at").over(Window.partitionBy(*group, "word").orderBy("at"))
    rows = rows.withColumn("again", again)
    begin = F.greatest(F.coalesce("again", F.lit(-1)) + 1, F.col("at") - F.col("span") + 1)
    ends = F.explode(F.array(F.struct(begin.alias("x"), F.lit(1).alias("change")), F.struct((F.col("at") + 1).alias("x"), F.lit(-1).alias("change"))))
    ends = rows.select(*group, "label", "size", "needed", ends.alias("e")).select(*group, "label", "size", "needed", "e.*")
    covering = F.sum("change").over(Window.partitionBy(*group).orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    best = ends.withColumn("common", covering).groupBy(*group, "label", "size", "needed").agg(F.max("common").alias("common")).where("common >= needed")
    return best.select(*group, "label", (F.col("common") / F.col("size")).alias("containment"))


def phrase_matches(places: DataFrame, keys: list[str], phrases: list[tuple[str, str]] = PHRASES) -> DataFrame:
    """keys, label, at: every place where a phrase's words stand consecutively."""
    spark = places.sparkSession
    words = [(w, number, label, place, len(phrase.split())) for number, (phrase, label) in enumerate(phrases) for place, w in enumerate(phrase.split())]
    index = spark.createDataFrame(words, "word string, phrase int, label string, place int, size int")  # a row for each word of a phrase
    rows = places.join(F.broadcast(index), "word")
    if all(len(set(p.split())) == len(p.split()) for p, _ in phrases):
        # A text's neighbouring places of the phrase's words are the phrase, if they follow on each other.
        order, width = Window.partitionBy(*keys, "phrase").orderBy("at"), max((len(p.split()) for p, _ in phrases), default=1)
        follows = [(F.lead("at", k).over(order) == F.col("at") + k) & (F.lead("place", k).over(order) == k) | (F.col("size") <= k) for k in range(1, width)]
        found = rows.withColumn("whole", reduce(lambda x, y: x & y, follows, F.lit(True))).where("place = 0 and whole")
        return found.select(*keys, "label", "at")
    # A word that stands twice in a phrase stands at two of its places: each place votes for its begin.
    votes = rows.select(*keys, "phrase", "label", "size", (F.col("at") - F.col("place")).alias("at"))
    return votes.groupBy(*keys, "phrase", "label", "size", "at").count().where("count = size").select(*keys, "label", "at")


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES, contained: float = CONTAINED, wrapped: bool = True) -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is the best containment of a template in a block, 0 without a match. Blocks
    are runs of words, or lines if not ``wrapped``.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    keys = ["key1", "key2"]
    rows = rows.withColumns({"key1": F.xxhash64("id", "text"), "key2": F.xxhash64("text", F.lit(6))})
    places, counts = places_of_interest(rows, keys, "text", templates if wrapped else [], phrases, contained)
    found = wrapped_matches(places, counts, keys, templates, contained) if wrapped else matches(rows.select(*keys, "text"), keys, "text", templates, contained)
    base = phrase_matches(places, keys, phrases)
    # One row a text, from its places of phrases and its templates.
    none = F.lit(None)
    both = base.select(*keys, F.col("label").alias("named"), F.col("at").cast("bigint").alias("at"), F.lit(1).alias("base"), none.cast("string").alias("label"), none.cast("double").alias("score"))
    both = both.unionByName(found.select(*keys, none.cast("string").alias("named"), none.cast("bigint").alias("at"), F.lit(0).alias("base"), "label", F.col("containment").alias("score")))
    known = both.groupBy(*keys).agg(F.sum("base").alias("n_base"), F.min("at").alias("first_word"), F.max("at").alias("last_word"), F.collect_set("named").alias("named"), F.collect_set("label").alias("found"), F.max("score").alias("score"))

    packed = spaced(F.col("text"))
    n_words = F.when(packed == "", 0).otherwise(F.length(packed) - F.length(F.replace(packed, F.lit(" "))) + 1)
    out = rows.select("id", *keys, n_words.cast("bigint").alias("n_words")).join(known, keys, "left")
    empty = F.array().cast("array<string>")
    named, every = F.coalesce("named", empty), F.array_union(F.coalesce("named", empty), F.coalesce("found", empty))
    return out.select(
        F.col("id").alias(id_column),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        "first_word",
        "last_word",
        F.array_join(F.array_sort(named), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
