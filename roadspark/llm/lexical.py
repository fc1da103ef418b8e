"""Ranked lexical search over a length-stratified index (op 12).

A document of n terms has the normaliser m = 25 + (75 * n * N) div L, where N documents hold L
terms together. Documents of equal m are a stratum: in it the impact of a term,
(1000000000 * tf) div (1000 * tf + 8 * m), depends on tf alone, so postings are grouped by
stratum, term and tf and each impact is computed once. The largest tf of a term in a stratum
bounds what the term can give there, and the sum over an item's terms bounds its score in the
stratum: an item visits strata from the highest bound down, and stops at the first that cannot
reach its k-th best document so far. Visits only leave out what cannot be among the best, so
results are exact.

In Spark: one pass over the texts writes the postings of all documents for the terms that the
items use, with every document's n; counts over that table give N, L and each term's number of
documents. The postings are then dealt and sorted by m (a stratum of many documents is cut
between tasks); a task searches the strata it has for all items, keeps the k best documents of
each and the score they reached for its next shard, and a window joins what the tasks kept.

Items are taken in blocks of at most BLOCK_BYTES of text, whose vocabulary is broadcast; a larger
set of items makes several passes. Terms are compared by 64-bit hashes (see words.py).

Terms are runs of ASCII letters (A-Z lower-cased), digits and non-ASCII characters of the whole
text. Null and wordless documents are in no count and in no result; null or wordless items have
no rows. Documents are judged row by row: rows that repeat an id are documents of their own, and
a null id ranks behind all others of its score. Rows that repeat an item (id and text) are one
item; different texts under one id are items of their own, with ranks from 1 each. Equal scores
rank by ascending document id. Other columns play no part. Without documents or items there are
no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, received, saved, ship, text_slices
from .words import split_words

K = 10
#: Item text of one block.
BLOCK_BYTES = 1 << 20
#: Postings that a task searches at a time.
SHARD_POSTINGS = 1 << 20


class Items:
    """A block of items: their vocabulary, the items of each term, and the terms of each item."""

    def __init__(self, texts: list[str]):
        parts = [t.encode() for t in texts]
        bounds = np.append(0, np.cumsum([len(p) for p in parts], dtype=np.int64)) if parts else np.zeros(1, np.int64)
        words, at = split_words(np.frombuffer(b"".join(parts), np.uint8), bounds)
        self.n = len(texts)
        self.vocabulary, number = np.unique(words, return_inverse=True)
        item = np.repeat(np.arange(self.n), np.diff(at))
        pairs, self.times = np.unique(item * max(1, len(self.vocabulary)) + number, return_counts=True)
        self.item, self.term = pairs // max(1, len(self.vocabulary)), pairs % max(1, len(self.vocabulary))
        self.weight = np.zeros(len(pairs), np.int64)

    def weigh(self, documents: int, holding: dict[int, int]) -> None:
        """The weight of each item's terms, repeats included, from the numbers of documents."""
        df = np.array([holding.get(k, 0) for k in range(len(self.vocabulary))], np.int64)
        w = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        self.weight = self.times * w[self.term] if len(w) else self.weight
        self.item_at = np.searchsorted(self.item, np.arange(self.n + 1))
        self.by_term = np.argsort(self.term, kind="stable")
        self.term_at = np.searchsorted(self.term[self.by_term], np.arange(len(self.vocabulary) + 1))


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of several ranges, one after the other."""
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


class Strata:
    """Documents by stratum, their postings by stratum, term and tf.

    ``doc``, ``term`` and ``tf`` are postings, ``doc`` an index into ``m``, the normalisers of
    the documents in ascending order.
    """

    def __init__(self, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray):
        self.values, self.doc_at = np.unique(m, return_index=True)
        self.doc_at = np.append(self.doc_at, len(m))
        stratum = np.searchsorted(self.values, m)[doc]
        order = np.lexsort((doc, tf, term, stratum))
        self.doc, stratum, term, tf = doc[order], stratum[order], term[order].astype(np.int64), tf[order].astype(np.int64)
        new = np.append(True, (np.diff(stratum) != 0) | (np.diff(term) != 0))[: len(doc)]
        level = new | np.append(True, np.diff(tf) != 0)[: len(doc)]
        heads = np.flatnonzero(level)
        # One impact for each stratum, term and tf.
        impact = 1_000_000_000 * tf[heads] // (1000 * tf[heads] + 8 * self.values[stratum[heads]])
        self.impact = impact[np.cumsum(level) - 1]
        self.begin = np.flatnonzero(new)
        self.size = np.diff(np.append(self.begin, len(doc)))
        self.stratum, self.term = stratum[self.begin], term[self.begin]
        self.most = self.impact[self.begin + self.size - 1]
        self.stratum_at = np.searchsorted(self.stratum, np.arange(len(self.values) + 1))

    def bounds(self, items: Items) -> np.ndarray:
        """What each item can reach in each stratum at most."""
        out = np.zeros((len(self.values), items.n), np.int64)
        for s, row in enumerate(out):
            own = slice(self.stratum_at[s], self.stratum_at[s + 1])
            term = self.term[own]
            used = items.term_at[term + 1] - items.term_at[term]
            pair = items.by_term[_ranges(items.term_at[term], used)]
            np.add.at(row, items.item[pair], items.weight[pair] * np.repeat(self.most[own], used))
        return out

    def scores(self, items: Items, item: int, s: int) -> np.ndarray:
        """An item's score with each document of a stratum."""
        own = slice(items.item_at[item], items.item_at[item + 1])
        terms, lists = items.term[own], self.term[self.stratum_at[s] : self.stratum_at[s + 1]]
        at = np.searchsorted(lists, terms)
        there = np.flatnonzero(lists[np.minimum(at, len(lists) - 1)] == terms)
        group = at[there] + self.stratum_at[s]
        posting = _ranges(self.begin[group], self.size[group])
        out = np.zeros(self.doc_at[s + 1] - self.doc_at[s], np.int64)
        np.add.at(out, self.doc[posting] - self.doc_at[s], self.impact[posting] * np.repeat(items.weight[own][there], self.size[group]))
        return out

    def search(self, items: Items, tie: np.ndarray, k: int, reached: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, document and score of the k best of each item; ties by ``tie``.

        ``reached`` holds scores that k documents have elsewhere: what is below is left out. It
        is raised to what is reached here.
        """
        bounds, found = self.bounds(items), []
        for item in range(items.n):
            doc, score, least = np.zeros(0, np.int64), np.zeros(0, np.int64), max(1, int(reached[item]))
            for s in np.argsort(-bounds[:, item], kind="stable"):
                if bounds[s, item] < least:
                    break
                here = self.scores(items, item, s)
                may = np.flatnonzero(here >= least)
                doc, score = np.append(doc, may + self.doc_at[s]), np.append(score, here[may])
                first = np.lexsort((tie[doc], -score))[:k]
                doc, score = doc[first], score[first]
                if len(doc) == k:
                    least = max(least, int(score[-1]))
            reached[item] = least
            found.append((np.full(len(doc), item, np.int64), doc, score))
        return tuple(np.concatenate([np.zeros(0, np.int64), *part]) for part in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def _postings(docs: DataFrame, items: Items) -> DataFrame:
    """row, doc_id, n, terms, tfs of every document with a term; terms are those of the items."""
    shared = ship(docs.sparkSession, items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = received(Items, shared).vocabulary
        size = max(1, len(vocabulary))
        for batch in batches:
            for part, data, bounds in text_slices(batch, "text"):
                words, at = split_words(data, bounds)
                n = np.diff(at)
                number = np.minimum(np.searchsorted(vocabulary, words), size - 1)
                known = vocabulary[number] == words if len(vocabulary) else np.zeros(len(words), bool)
                pairs, tf = np.unique(np.repeat(np.arange(len(n)), n)[known] * size + number[known], return_counts=True)
                offsets = pa.array(np.searchsorted(pairs, np.arange(len(n) + 1) * size).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (pairs % size, tf)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), *lists], ["doc_id", "n", "terms", "tfs"]).filter(pa.array(n > 0))

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.mapInArrow(run, f"doc_id {kind}, n bigint, terms array<int>, tfs array<int>")
    return saved(found.select(F.monotonically_increasing_id().alias("row"), "*"), "postings")


def _searched(index: DataFrame, items: Items, ids: pa.Array, k: int, kind: str) -> DataFrame:
    """number and item_id of the item, doc_id, score: the k best of each shard. ``index`` is in the order of m."""
    shared, names = ship(index.sparkSession, items), index.sparkSession.sparkContext.broadcast(ids)

    def shard(block: Items, held: list[pa.RecordBatch], reached: np.ndarray) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        m = rows.column("m").to_numpy()
        order = np.argsort(m, kind="stable")  # shards are in the order of m already
        rows, m = rows.take(pa.array(order)), m[order]
        terms, tfs = (rows.column(c).combine_chunks() for c in ("terms", "tfs"))
        doc = np.repeat(np.arange(len(m)), pc.list_value_length(terms).to_numpy())
        tie = np.empty(len(m), np.int64)
        tie[pc.sort_indices(rows.column("doc_id")).to_numpy()] = np.arange(len(m))  # nulls come last
        item, at, score = Strata(m, doc, terms.flatten().to_numpy(), tfs.flatten().to_numpy()).search(block, tie, k, reached)
        number = pa.array(item)
        return pa.RecordBatch.from_arrays([number, names.value.take(number), rows.column("doc_id").combine_chunks().take(pa.array(at)), pa.array(score)], ["number", "item_id", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = received(Items, shared)
        reached = np.zeros(block.n, np.int64)
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column("terms").flatten())
            if size >= SHARD_POSTINGS:
                yield shard(block, held, reached)
                held, size = [], 0
        if held:
            yield shard(block, held, reached)

    return index.mapInArrow(run, f"number bigint, item_id {kind}, doc_id {index.schema['doc_id'].dataType.simpleString()}, score bigint")


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[pa.Table]:
    """The items in blocks, each in a fixed order."""
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    for k in range(blocks):
        found = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).distinct().toArrow()
        if found.num_rows:
            yield found.sort_by([("text", "ascending"), ("item_id", "ascending")]).combine_chunks()


def search(docs: DataFrame, items: DataFrame, k: int = K, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents that score highest for each item, as
    far as they score above 0."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).where("text is not null")
    asked = items.select(F.col(item_column).alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    parts = [_ranked(texts, block, k, asked.schema["item_id"].dataType.simpleString()) for block in _blocks(asked, block_bytes)]
    schema = f"item_id {asked.schema['item_id'].dataType.simpleString()}, rank int, doc_id {texts.schema['doc_id'].dataType.simpleString()}, score bigint"
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _ranked(texts: DataFrame, block: pa.Table, k: int, kind: str) -> DataFrame:
    items = Items(block.column("text").to_pylist())
    postings = _postings(texts, items)
    documents, length = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # A row for each term of the block at most.
    holding = {r[0]: r[1] for r in postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
    items.weigh(documents, holding)
    m = F.expr(f"cast(25 + (cast(75 * n as decimal(20,0)) * cast({documents} as decimal(18,0))) div {max(1, length)} as bigint)")
    index = postings.where(F.size("terms") > 0).select("row", "doc_id", m.alias("m"), "terms", "tfs")
    index = index.repartitionByRange("m", F.xxhash64("row")).sortWithinPartitions("m").select("doc_id", "m", "terms", "tfs")
    found = _searched(index, items, block.column("item_id").combine_chunks(), k, kind)
    rank = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
