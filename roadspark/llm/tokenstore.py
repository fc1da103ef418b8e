"""Token ids in a file format of directly addressable codes (op 5).

A token id is split into chunks of ``width`` bits. Level k holds the k-th chunk of every
id that has one, and a bitmap that says which of them continue on level k + 1. A rank
directory (ones before each block of the bitmap) turns a place on one level into the place
on the next, so any token is read with one step a level and no block is decoded.

A store is a folder of Parquet files in ascending document order. A row is a document:
``part`` (the file's place in the order), ``seq`` (the row's place in the file), ``doc_id``,
``n_tokens`` and ``levels``, an array of (count, chunks, more, ranks). Tasks write their own
files with Spark's committer.

Null text is empty: such a document holds the end id alone. A very long text is encoded whole,
by itself, and is one row of the store. Rows that repeat a doc_id are
all kept, next to each other; a null doc_id sorts first. An empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, kept_between_tasks, text_slices

WIDTH = 8
#: Bits of a bitmap between two entries of its rank directory.
RANK_BITS = 512
#: Parts of texts, and ids of such, kept by a Python process, so that common words are encoded once.
CACHED_PARTS, CACHED_IDS = 500_000, 4_000_000
#: Text bytes that are encoded at a time (a longer text is encoded alone).
ENCODED_BYTES = 2 << 20
#: Characters of a text by which rows that repeat an id are ordered.
HEAD = 64
LEVEL = "struct<count:bigint,chunks:binary,more:binary,ranks:binary>"

_ITEM = pa.struct([("count", pa.int64()), ("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())])


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary values of given sizes in bytes, cut from one array."""
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _places(sizes: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each element lies when every sequence starts at a multiple of ``step``, and the starts."""
    starts = np.append(0, np.cumsum(-(-sizes // step) * step))
    first = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts[:-1] - first, sizes), starts


def pack(ids: np.ndarray, sizes: np.ndarray, width: int = WIDTH) -> pa.Array:
    """The levels of many sequences, given one after the other: a list for each, with none for
    an empty one."""
    dtype = np.dtype(np.uint8 if width <= 8 else "<u2")
    rest, own, size = np.asarray(ids, np.uint32), np.flatnonzero(sizes), np.asarray(sizes)[np.flatnonzero(sizes)]
    parts, owners = [], []
    while len(rest):
        chunk = (rest & np.uint32((1 << width) - 1)).astype(dtype)
        rest = rest >> np.uint32(width)
        more = rest > 0
        at, starts = _places(size, 8)
        bits = np.zeros(starts[-1], bool)
        bits[at] = more
        # Ones of a sequence before each block of its bitmap.
        first = np.cumsum(size) - size
        blocks = -(-size // RANK_BITS)
        block = np.repeat(first, blocks) + (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * RANK_BITS
        ones = np.append(0, np.cumsum(more))
        ranks = (ones[block] - np.repeat(ones[first], blocks)).astype("<u4")
        parts.append(pa.StructArray.from_arrays([pa.array(size, pa.int64()), _binary(chunk, size * dtype.itemsize), _binary(np.packbits(bits, bitorder="little"), -(-size // 8)), _binary(ranks, blocks * 4)], fields=list(_ITEM)))
        owners.append(own)
        left = np.add.reduceat(more.astype(np.int64), first)
        rest, own, size = rest[more], own[left > 0], left[left > 0]
    if not parts:
        return pa.array([[]] * len(sizes), pa.list_(_ITEM))
    owner = np.concatenate(owners)
    items = pa.concat_arrays(parts).take(pa.array(np.argsort(owner, kind="stable")))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(owner, minlength=len(sizes)))), pa.int32()), items)


def unpack(levels: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The ids of many sequences, one after the other, and their sizes."""
    dtype = np.dtype(np.uint8 if width <= 8 else "<u2")
    counts = levels.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    items = levels.flatten()
    depth = np.arange(len(items)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = np.zeros(0, np.uint32)
    for level in range(int(counts.max(initial=0)) - 1, -1, -1):
        some = items.filter(pa.array(depth == level))
        size = some.field("count").to_numpy()
        value = np.frombuffer(_joined(some.field("chunks")), dtype).astype(np.uint32)
        at, _ = _places(size, 8)
        more = np.unpackbits(np.frombuffer(_joined(some.field("more")), np.uint8), bitorder="little")[at].astype(bool)
        value[more] |= out << np.uint32(width)
        out = value
    sizes = np.zeros(len(levels), np.int64)
    sizes[counts > 0] = items.filter(pa.array(depth == 0)).field("count").to_numpy()
    return out, sizes


def _joined(values: pa.Array) -> bytes:
    """The bytes of binary values, one after the other."""
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    return memoryview(values.buffers()[2] or b"")[offsets[0] : offsets[-1]]


def token_at(levels: list[dict], at: int, width: int = WIDTH) -> int:
    """The id at one place, by rank alone."""
    if not levels or not 0 <= at < levels[0]["count"]:
        raise IndexError(at)
    dtype = np.uint8 if width <= 8 else np.uint16
    value = 0
    for k, level in enumerate(levels):
        value |= int(np.frombuffer(level["chunks"], dtype, 1, at * np.dtype(dtype).itemsize)[0]) << (k * width)
        if not level["more"][at >> 3] >> (at & 7) & 1:
            break
        block = at // RANK_BITS
        bits = np.frombuffer(level["more"], np.uint8, ((at & 7) > 0) + (at >> 3) - block * RANK_BITS // 8, block * RANK_BITS // 8)
        ones = np.unpackbits(bits, bitorder="little")[: at - block * RANK_BITS].sum()
        at = int(np.frombuffer(level["ranks"], "<u4")[block] + ones)
    return value


def tokens_at(levels: list[dict], at: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The ids at many places of one document, by rank alone; -1 where there is no such place."""
    out = np.full(len(at), -1, np.int64)
    some = np.flatnonzero((at >= 0) & (at < (levels[0]["count"] if levels else 0)))
    out[some] = 0
    at = np.asarray(at, np.int64)[some]
    dtype = np.uint8 if width <= 8 else np.dtype("<u2")
    for k, level in enumerate(levels):
        out[some] |= np.frombuffer(level["chunks"], dtype)[at].astype(np.int64) << (k * width)
        bitmap = np.frombuffer(level["more"], np.uint8)
        goes_on = (bitmap[at >> 3] >> (at & 7) & 1).astype(bool)
        some, at = some[goes_on], at[goes_on]
        if not len(some):
            break
        # Ones of the block before the place: whole bytes, and the bits of its own byte.
        block = at // RANK_BITS
        byte = block[:, None] * (RANK_BITS // 8) + np.arange(RANK_BITS // 8)
        before = np.where(byte < (at >> 3)[:, None], _ONES[bitmap[np.minimum(byte, len(bitmap) - 1)]], 0).sum(1)
        own = _ONES[bitmap[at >> 3] & ((1 << (at & 7)) - 1).astype(np.uint8)]
        at = np.frombuffer(level["ranks"], "<u4")[block].astype(np.int64) + before + own
    return out


#: Ones of each byte.
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.int64)


def byte_characters() -> dict[int, str]:
    """How byte-level BPE writes bytes: printable Latin-1 as itself, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


_SPACE_CHARACTER = "Ġ"  # how byte-level BPE writes a space


class _Parts(dict):
    """Places of parts; a new part is learned when it is first asked for."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, part: str) -> int:
        found = self[part] = self.learn(part)
        return found


class WordEncoder:
    """Byte-level BPE of whole texts, part by part.

    The tokenizer's pattern always cuts at the places that :func:`part_starts` finds, and the
    parts between them encode alone as they do in their text. The parts of a slice become one
    dictionary-encoded column: each different part is looked up once, and a gather over the
    whole slice puts the ids in place. Ids of parts stay in a cache of bounded size.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bytes = byte_characters()
        #: Strings with ids of their own; no part may begin inside one.
        self.whole = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._empty()

    def _empty(self) -> None:
        #: Part -> its place among the cached ones; their ids lie one after the other.
        self.known = _Parts(self._learn)
        self.ids, self.ends = array("I"), array("q", [0])

    def _learn(self, part: str) -> int:
        """The place of a new part: of a word by the model alone, of anything else by the whole tokenizer."""
        word = part[1:] if part[:1] == " " else part
        if word.isalpha():
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(self.bytes)
            for token in self.model.tokenize(_SPACE_CHARACTER + word if part[:1] == " " else word):
                self.ids.append(token.id)
        else:
            self.ids.extend(self.tokenizer.encode(part, add_special_tokens=False).ids)
        self.ends.append(len(self.ids))
        return len(self.ends) - 2

    def encode(self, data: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id, one after the other, and their sizes."""
        if len(self.known) > CACHED_PARTS or len(self.ids) > CACHED_IDS:
            self._empty()
        starts = part_starts(data, bounds, self.whole)
        # An empty part at the end of each text stands for the end id.
        last = np.searchsorted(starts, bounds[1:])
        offsets = np.append(np.insert(starts, last, bounds[1:]), len(data)).astype(np.int32)
        last += np.arange(len(last))
        parts = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
        different = parts.dictionary.to_numpy(zero_copy_only=False)
        place = np.fromiter(map(self.known.__getitem__, different), np.int64, len(different))
        own = parts.indices.to_numpy()
        ends = np.frombuffer(self.ends, np.int64)
        begin, size = ends[place], ends[place + 1] - ends[place]
        begin, size = begin[own], size[own]
        size[last] = 1  # the end id
        to = np.cumsum(size)
        at = np.repeat(begin - to + size, size)
        at += np.arange(len(at))
        ends_at = to[last] - 1
        at[ends_at] = 0
        out = np.append(np.frombuffer(self.ids, np.uint32), np.uint32(end_id))[at]
        out[ends_at] = end_id
        return out, np.diff(np.append(0, to[last]))


_INNER, _LETTER, _MARK, _QUOTE, _SPACE, _BREAK = range(6)
_KIND = np.full(256, _INNER, np.uint8)
_KIND[:128] = _MARK
_KIND[[k for k in range(128) if chr(k).isalpha()]] = _LETTER
_KIND[[*range(9, 14), *range(28, 33)]] = _SPACE
_KIND[39] = _QUOTE
_SOLID = np.isin(_KIND, (_LETTER, _MARK, _QUOTE))
_SOLID[48:58] = True
_KIND[48:58] = _BREAK  # digits: like letters, but a letter and a digit part company
#: White space beyond ASCII, as bytes; a space or line break after it is no sure cut.
_WIDE_SPACES = [c.encode() for c in "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"]


def part_starts(data: np.ndarray, bounds: np.ndarray, whole: list[bytes] = ()) -> np.ndarray:
    """Where parts of texts begin that encode alone as they do in their text.

    Sure cuts are: a text's begin; a space or line break after what is not white space; a
    mark after a letter or digit of ASCII; a letter or digit after a mark that is not an
    apostrophe; what follows a line break that is itself cut off, if that is not white space
    or is one space before what is not. There are none inside the strings ``whole``.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = _KIND[data]
    solid = _SOLID[data]  # ASCII that is not white space
    full = solid | (data >= 128)
    lead = data >= 0xC2
    if (lead & (data <= 0xE3) & (data != 0xC3)).any():
        for wide in _WIDE_SPACES:
            found = data == wide[-1]
            for k, byte in enumerate(wide[-2::-1], 1):
                found[k:] &= data[:-k] == byte
                found[:k] = False
            for k in range(len(wide)):
                full[np.flatnonzero(found) - k] = False
    cut = np.zeros(n, bool)
    gap = (data == 32) | (data == 10)
    cut[1:] = gap[1:] & full[:-1]
    word = (kind == _LETTER) | (kind == _BREAK)
    mark = (kind == _MARK) | (kind == _QUOTE)
    cut[1:] |= mark[1:] & word[:-1]
    cut[1:] |= word[1:] & (kind[:-1] == _MARK)
    edge = bounds[:-1][bounds[:-1] < n]
    cut[edge] = False
    broken = cut & (data == 10)
    if broken.any():
        at = np.flatnonzero(broken[:-1])
        after = full[at + 1] | ((data[at + 1] == 32) & np.append(full, False)[np.minimum(at + 2, n)])
        first = np.zeros(n + 1, bool)
        first[bounds] = True
        inside = ~first[at + 1] & ((data[at + 1] != 32) | ~first[np.minimum(at + 2, n)])
        cut[at[after & inside] + 1] = True
    raw = data.tobytes() if len(whole) else b""
    for string in whole:
        at = raw.find(string)
        while at >= 0:
            cut[at + 1 : at + len(string)] = False
            at = raw.find(string, at + 1)
    cut[edge] = True
    return np.flatnonzero(cut)


def _encoded(path: str, end_id: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_between_tasks().setdefault(path, None) or WordEncoder(path)
        kept_between_tasks()[path] = encoder
        seq = 0
        for batch in batches:
            for part, data, bounds in text_slices(batch, "text", ENCODED_BYTES):
                ids, sizes = encoder.encode(data, bounds, end_id)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.arange(seq, seq + len(sizes))), part.column(1), pa.array(sizes), pack(ids, sizes, width)], ["part", "seq", "doc_id", "n_tokens", "levels"])
                seq += len(sizes)

    return run


def write_store(docs: DataFrame, path: str, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", end_id: int = 0, width: int = WIDTH) -> None:
    """Encode every text and write the store to ``path``, in ascending id order.

    Documents are dealt by ranges of their id, of the head of their text and of its hash, so
    rows that repeat one id are spread too; they sort in that order, rows that are equal
    altogether side by side. A range is sorted with spilling and read in bounded batches, so
    its size is not bounded by memory; the session's partition count says how many there are.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.substring("text", 1, HEAD), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(
        _encoded(tokenizer, end_id, width), f"part int, seq bigint, doc_id {dict(rows.dtypes)['doc_id']}, n_tokens bigint, levels array<{LEVEL}>"
    ).write.option("compression", "zstd").parquet(path)


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a store: part, seq, doc_id, n_tokens, levels."""
    return spark.read.parquet(path)


def _sums(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                ids, sizes = unpack(rows.column(3), width)
                raw, ends = ids.astype("<u4", copy=False).tobytes(), np.cumsum(sizes) * 4
                crcs = [zlib.crc32(memoryview(raw)[e - 4 * n : e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(2), pa.array(sizes), pa.array(crcs, pa.int64())], ["part", "seq", "doc_id", "n_tokens", "ids_crc32"])

    return run


def document_index(store: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document, read back from the store: doc_id, start, n_tokens, ids_crc32.

    ``start`` is a prefix sum in two steps: over the parts (a row for each file of the store)
    and within each part.
    """
    kind = dict(store.dtypes)["doc_id"]
    rows = store.select("part", "seq", "doc_id", "levels").mapInArrow(_sums(width), f"part int, seq bigint, doc_id {kind}, n_tokens bigint, ids_crc32 bigint")
    sums = store.groupBy("part").agg(F.sum("n_tokens").alias("sum"))
    before = sums.select("part", (F.sum("sum").over(Window.orderBy("part")) - F.col("sum")).alias("before"))
    inside = Window.partitionBy("part").orderBy("seq")
    return rows.withColumn("inside", F.sum("n_tokens").over(inside) - F.col("n_tokens")).join(before, "part").select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


#: Places of one document that a row brings to the store at most.
PLACES = 1 << 16


def lookup(store: DataFrame, wanted: DataFrame, id_column: str = "doc_id", at_column: str = "at", width: int = WIDTH) -> DataFrame:
    """id_column, at_column, token for every different pair of ``wanted``: the id at a place of
    a document, counted from 0; null if there is no such place or document.

    Each place is read through the rank directories of its document's levels, and nothing else
    of it is decoded. Documents that repeat an id give a row each; null ids and places find
    nothing. The store is joined by id, so where few ids are wanted Spark brings them to it.
    """
    pairs = wanted.select(F.col(id_column).alias("doc_id"), F.col(at_column).cast("bigint").alias("at")).distinct()
    asked = pairs.where("doc_id is not null and at is not null").groupBy("doc_id", F.floor(F.col("at") / PLACES).alias("stretch")).agg(F.collect_list("at").alias("places"))
    met = store.select("doc_id", "levels").join(asked, "doc_id").select("doc_id", "places", "levels")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at = batch.column(1)[row].values.to_numpy()
                found = tokens_at(batch.column(2)[row].as_py() or [], at, width)
                ids = batch.column(0).take(pa.array(np.full(len(at), row)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(at), pa.array(found, mask=found < 0)], ["doc_id", "at", "token"])

    kind = dict(store.dtypes)["doc_id"]
    found = met.mapInArrow(run, f"doc_id {kind}, at bigint, token bigint")
    out = pairs.join(found, (pairs["doc_id"] == found["doc_id"]) & (pairs["at"] == found["at"]), "left")
    return out.select(pairs["doc_id"].alias(id_column), pairs["at"].alias(at_column), "token")
