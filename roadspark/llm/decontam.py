"""Benchmark decontamination with suffix arrays (op 4).

Documents are read in shards of a few MB. A task numbers a shard's words by the benchmark's
vocabulary and sorts its suffixes: the shard's suffix array. A suffix ends at the first word that
the benchmark never uses, and one that begins with such a word agrees with no item; suffixes
that agree in a whole window stay in any order. Every suffix of every item is then looked up by binary search.
Its neighbours in the order hold its longest match, up to a window; where that reaches a whole
window, the interval around it holds all places of the window. Places on one diagonal join
into verbatim matches, whose longest per item and document is returned with its location, and
whose words are the hits that a document is removed for. ``item_matches`` returns the longest
match that each item has in the corpus, however short that is.

A window is ``size`` consecutive words of an item; a shorter item, but not an empty one, is
one window. Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters.

The benchmark's size is checked: the index of at most BLOCK_BYTES of its text is broadcast at
a time (INDEX_BYTES bounds the index itself; a single item beyond it is an error), a larger
benchmark makes several passes, each adding to the same column. Words are compared by 64-bit
hashes. Null texts have no words. Item ids that repeat count once; a null item id is written
as ``null``, and an item whose id is that word is the same item. Repeated and
null-id documents are judged row by row, and all their columns stay. Empty tables are fine:
without items nothing is hit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, free_name, received, ship, text_slices
from .words import split_words

WINDOW = 13
#: Benchmark text in one broadcast, and the bytes of its index at most.
BLOCK_BYTES, INDEX_BYTES = 4 << 20, 256 << 20
#: Document text that becomes a suffix array at a time (a longer text is one of its own).
SHARD_BYTES = 2 << 20
STATE = "struct<n_words:bigint,n_hit:bigint,matches:array<struct<item_id:string,item_start:int,doc_start:int,length:int>>,hits:array<struct<begin:int,end:int>>>"
STATE_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("matches", pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("length", pa.int32())]))),
        ("hits", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
    ]
)


class Items:
    """A block of benchmark items: vocabulary, windows, and sort keys of all suffixes."""

    def __init__(self, ids: list[str], texts: list[str], size: int):
        data = "\n".join(texts).encode()
        lengths = np.array([len(t.encode()) for t in texts], np.int64)
        bounds = np.append(np.cumsum(lengths + 1) - (lengths + 1), len(data)) if texts else np.zeros(1, np.int64)
        words, at = split_words(np.frombuffer(data, np.uint8), bounds)
        counts = np.diff(at)
        self.ids, self.size = ids, size
        self.vocabulary = np.unique(words)
        self.numbers, self.word_at = np.append(np.searchsorted(self.vocabulary, words) + 1, 0).astype(np.int32), at
        windows = np.where(counts >= size, counts - size + 1, (counts > 0).astype(int))
        self.item = np.repeat(np.arange(len(texts), dtype=np.int32), windows)
        self.start = (np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)).astype(np.int32)
        self.length = np.minimum(counts, size).astype(np.int16)[self.item]
        self.bits = max(1, int(math.ceil(math.log2(len(self.vocabulary) + 2))))
        places = np.arange(len(words))
        # words of each suffix, of which a window at most is looked at
        self.left = np.minimum(np.repeat(at[1:], counts) - places, size).astype(np.int16)
        self.low = pack_keys(self.numbers, places, self.left, size, self.bits, False)
        self.high = pack_keys(self.numbers, at[self.item] + self.start, self.length, size, self.bits, True)
        held = sum(x.nbytes for x in (self.vocabulary, self.numbers, self.word_at, self.item, self.start, self.length, self.left, *self.low, *self.high))
        if held > INDEX_BYTES:
            raise ValueError(f"the index of one block of the benchmark takes {held} bytes of {INDEX_BYTES}")


def pack_keys(numbers: np.ndarray, places: np.ndarray, lengths: np.ndarray, size: int, bits: int, fill: bool) -> list[np.ndarray]:
    """The first words from each place as a few 64-bit keys that sort like the words.

    Beyond its length a key holds zeros, or ones if ``fill``.
    """
    per = 64 // bits
    pad = np.uint64((1 << bits) - 1 if fill else 0)
    keys = []
    for first in range(0, size, per):
        key = np.zeros(len(places), np.uint64)
        for k in range(first, first + per):
            word = numbers[np.minimum(places + k, len(numbers) - 1)].astype(np.uint64) if k < size else np.zeros(len(places), np.uint64)
            key = (key << np.uint64(bits)) | np.where(k < lengths, word, pad if k < size else np.uint64(0))
        keys.append(key)
    return keys


def bisect(sorted_keys: list[np.ndarray], wanted: list[np.ndarray], right: bool) -> np.ndarray:
    """Binary search of many composite keys at once."""
    low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(sorted_keys[0]), np.int64)
    while (low < high).any():
        mid = (low + high) >> 1
        at = np.minimum(mid, len(sorted_keys[0]) - 1)
        less, same = np.zeros(len(mid), bool), np.ones(len(mid), bool)
        for have, want in zip(sorted_keys, wanted):
            less |= same & (have[at] < want)
            same &= have[at] == want
        less |= same & right
        open_ = low < high
        low = np.where(open_ & less, mid + 1, low)
        high = np.where(open_ & ~less, mid, high)
    return low


def suffix_array(items: Items, words: np.ndarray, word_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """The number of each word of a shard (0: not in the benchmark), and the places of its
    suffixes in sorted order, the known words of each, their keys.

    A suffix ends at the first unknown word or at the end of its document.
    """
    number = np.searchsorted(items.vocabulary, words)
    number = np.where(items.vocabulary[np.minimum(number, len(items.vocabulary) - 1)] == words, number + 1, 0)
    n = len(words)
    stop = np.zeros(n + 1, bool)
    stop[:n] = number == 0
    stop[n] = True
    edges = np.union1d(np.flatnonzero(stop), word_at[1:])
    places = np.flatnonzero(~stop[:n])
    run = edges[np.searchsorted(edges, places, "right")] - places
    number = np.append(number, 0)
    keys = pack_keys(number, places, np.minimum(run, items.size), items.size, items.bits, False)
    order = np.lexsort(keys[::-1])
    return number, places[order], run[order], [k[order] for k in keys]


class Matches:
    """What the suffixes of all items have in a shard.

    For each suffix (a place in the items' words): ``common``, the words of its longest match, up
    to a window, and ``near``, where that begins in the shard. For each occurrence of a whole
    window: ``window``, ``place``, ``length``.
    """

    def __init__(self, items: Items, words: np.ndarray, word_at: np.ndarray):
        total = len(items.left)
        self.common, self.near = np.zeros(total, np.int64), np.zeros(total, np.int64)
        self.window = self.place = self.length = np.zeros(0, np.int64)
        if not total or not len(words):
            return
        number, suffixes, run, keys = suffix_array(items, words, word_at)
        if not len(suffixes):
            return
        # What agrees with a suffix longest is next to its place in the order.
        below = bisect(keys, items.low, False)
        for beside in (below, below - 1):
            k = np.flatnonzero((beside >= 0) & (beside < len(suffixes)))
            place = suffixes[beside[k]]
            common = agreement(items, k, number, place, np.minimum(items.left[k], run[beside[k]]))
            better = common > self.common[k]
            self.common[k[better]], self.near[k[better]] = common[better], place[better]
        # All places of the windows that occur: from the suffix's own place in the order on.
        suffix = items.word_at[items.item] + items.start
        occurs = np.flatnonzero(self.common[suffix] >= items.length)
        first = below[suffix[occurs]]
        found = bisect(keys, [key[occurs] for key in items.high], True) - first
        self.window = np.repeat(occurs, found)
        self.place = suffixes[np.repeat(first - np.cumsum(found) + found, found) + np.arange(len(self.window))]
        self.length = items.length[self.window]


def agreement(items: Items, suffix: np.ndarray, number: np.ndarray, place: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words, up to ``most``, items' suffixes and places of a shard have in common."""
    common, going = np.zeros(len(suffix), np.int64), np.arange(len(suffix))
    for k in range(items.size):
        going = going[most[going] > k]
        going = going[number[place[going] + k] == items.numbers[suffix[going] + k]]
        common[going] += 1
    return common


def shard_longest(items: Items, words: np.ndarray, word_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The longest verbatim match in a shard of each item that has one: item, length, the
    match's first word in the item, and in the shard."""
    got = Matches(items, words, word_at)
    at = np.flatnonzero(got.common)
    item = np.searchsorted(items.word_at, at, "right") - 1
    found = [(item, got.common[at], at - items.word_at[item], got.near[at])]
    # Matches of a window and more are joined from windows.
    doc = np.searchsorted(word_at, got.place, "right") - 1
    number_of = {name: k for k, name in enumerate(items.ids)}
    joined = [(number_of[m["item_id"]], m["length"], m["item_start"], m["doc_start"] + word_at[d]) for d, own in longest(items, got.window, got.place - word_at[doc], doc, got.length).items() for m in own]
    found.append(tuple(np.array(joined, np.int64).reshape(-1, 4).T))
    item, length, start, place = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((place, start, -length, item))
    order = order[np.append(True, np.diff(item[order]) != 0)[: len(order)]]
    return item[order], length[order], start[order], place[order]


def _intervals(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _pass(items_var, column: str, state: str, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = received(Items, items_var)
        for batch in batches:
            for part, data, bounds in text_slices(batch, column, SHARD_BYTES):
                words, word_at = split_words(data, bounds)
                got = Matches(items, words, word_at)
                window, place, length = got.window, got.place, got.length
                doc = np.searchsorted(word_at, place, "right") - 1
                hit = np.zeros(len(words) + 1, np.int64)
                np.add.at(hit, place, 1)
                np.add.at(hit, place + length, -1)
                hit = np.cumsum(hit)[: len(words)] > 0
                before = [None] * part.num_rows if first else part.column(state).to_pylist()
                for d, old in enumerate(before):
                    for span in (old or {}).get("hits") or ():
                        hit[word_at[d] + span["begin"] : word_at[d] + span["end"]] = True
                total = np.append(0, np.cumsum(hit))
                n_hit = total[word_at[1:]] - total[word_at[:-1]]
                matches = longest(items, window, place - word_at[doc], doc, length)
                rows = []
                for d, old in enumerate(before):
                    spans = []
                    if n_hit[d]:
                        begin, end = _intervals(hit[word_at[d] : word_at[d + 1]])
                        spans = [{"begin": int(b), "end": int(e)} for b, e in zip(begin, end)]
                    rows.append({"n_words": int(word_at[d + 1] - word_at[d]), "n_hit": int(n_hit[d]), "matches": ((old or {}).get("matches") or []) + matches.get(d, []), "hits": spans})
                keep = [k for k, name in enumerate(part.schema.names) if first or name != state]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(rows, STATE_ARROW)], [*(part.schema.names[k] for k in keep), state])

    return run


def longest(items: Items, window: np.ndarray, place: np.ndarray, doc: np.ndarray, length: np.ndarray) -> dict[int, list[dict]]:
    """Per document the longest verbatim match with each item: first by place among equals."""
    if not len(window):
        return {}
    item, start = items.item[window], items.start[window]
    order = np.lexsort((place, place - start, item, doc))
    doc, item, start, place, length = (x[order] for x in (doc, item, start, place, length))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | ((place - start)[1:] != (place - start)[:-1]) | (place[1:] != place[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(doc)) - 1
    size = place[tail] + length[tail] - place[head]
    best = np.lexsort((place[head], -size, item[head], doc[head]))
    d, i = doc[head][best], item[head][best]
    keep = best[np.append(True, (d[1:] != d[:-1]) | (i[1:] != i[:-1]))]
    out: dict[int, list[dict]] = {}
    for k in keep:
        h = head[k]
        out.setdefault(int(doc[h]), []).append({"item_id": items.ids[item[h]], "item_start": int(start[h]), "doc_start": int(place[h]), "length": int(size[k])})
    return out


def _item_pass(items_var: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = received(Items, items_var)
        for batch in batches:
            for part, data, bounds in text_slices(batch, "text", SHARD_BYTES):
                words, word_at = split_words(data, bounds)
                item, length, start, place = shard_longest(items, words, word_at)
                doc = np.searchsorted(word_at, place, "right") - 1
                named = pa.array(items.ids, pa.string()).take(pa.array(item))
                yield pa.RecordBatch.from_arrays([named, pa.array(length), pa.array(start), part.column("doc_id").take(pa.array(doc)), pa.array(place - word_at[doc])], ["item_id", "length", "item_start", "doc_id", "doc_start"])

    return run


def blocks_of(benchmark: DataFrame, item_column: str, item_text: str, size: int, block_bytes: int) -> Iterator[Broadcast]:
    """The index of one block of the benchmark after the other."""
    spark = benchmark.sparkSession
    texts = benchmark.select(F.coalesce(F.col(item_column).cast("string"), F.lit("null")).alias("i"), F.col(item_text).alias("t")).where("t is not null")
    total = texts.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    for k in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).distinct().collect()
        rows.sort()
        yield ship(spark, Items([r[0] for r in rows], [r[1] for r in rows], size))


def match(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """All columns of ``docs`` and a struct (its name is returned too): n_words, n_hit, the
    longest matches with their items and places, and the spans of hit words."""
    bounded_batches(docs.sparkSession)
    state = free_name(docs, "contamination")
    out = docs
    for k, items in enumerate(blocks_of(benchmark, item_column, item_text, size, block_bytes)):
        schema = docs.sparkSession.createDataFrame([], docs.schema).selectExpr("*", f"cast(null as {STATE}) as `{state}`").schema
        out = out.mapInArrow(_pass(items, text_column, state, k == 0), schema)
    return out, state


def item_matches(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, length, item_start, doc_id, doc_start for every item id: its longest verbatim
    match in all of ``docs``, in words, and one of the places of that length.

    Items that share no word with the corpus have length 0 and no place. Each block of the
    benchmark reads the documents once; a shard passes on one row an item.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    schema = f"item_id string, length bigint, item_start bigint, doc_id {texts.schema['doc_id'].dataType.simpleString()}, doc_start bigint"
    parts = [texts.mapInArrow(_item_pass(items), schema) for items in blocks_of(benchmark, item_column, item_text, size, block_bytes)]
    place = F.struct("length", "item_start", "doc_id", "doc_start")
    best = reduce(DataFrame.unionByName, parts).groupBy("item_id").agg(F.max(place).alias("m"))
    every = benchmark.select(F.coalesce(F.col(item_column).cast("string"), F.lit("null")).alias("item_id")).distinct()
    return every.join(best, "item_id", "left").select("item_id", F.coalesce("m.length", F.lit(0)).cast("bigint").alias("length"), "m.item_start", "m.doc_id", "m.doc_start")


def contaminated(state: str):
    """The rule: some word is hit, and at least one in twenty."""
    hit, words = F.col(f"`{state}`.n_hit"), F.col(f"`{state}`.n_words")
    return (hit > 0) & (20 * hit >= words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    found, state = match(docs, benchmark, **options)
    return found.where(~contaminated(state)).drop(state)


def verdicts(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 (of the sorted ids), contaminated, longest match."""
    found, state = match(docs.select(id_column, options.get("text_column", "text")), benchmark, **options)
    ids = F.array_sort(F.array_distinct(F.transform(F.col(f"{state}.matches"), lambda m: m["item_id"])))
    return found.select(
        id_column,
        f"{state}.n_words",
        f"{state}.n_hit",
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        contaminated(state).alias("contaminated"),
        F.coalesce(F.array_max(F.transform(F.col(f"{state}.matches"), lambda m: m["length"])), F.lit(0)).cast("bigint").alias("longest"),
    )
