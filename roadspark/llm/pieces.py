"""SentencePiece encoding and decoding with byte offsets (op 10).

The model file names its normaliser: a compiled character map (a double-array trie of
source prefixes with their replacements), white space handling and the space mark. Texts
are normalised here by longest prefix while recording for every normalised byte the source
source byte it came from; the library's pieces then project to spans of the original bytes.
A model may come with an empty map (the one that the query uses does): then texts are
normalised by white space rules alone, and the compiled map is exercised by tests with others.

Null text is empty and has the begin and end ids only. Texts are encoded whole, a very long one
by itself in one task. Ties between pieces are the library's to decide. Repeated rows, extra
columns and null ids pass through; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, free_name, text_slices

MARK = "▁".encode()
#: Texts that the library encodes at a time.
TEXTS = 256


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """The fields of a protocol buffer message: number, and an int or the bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = varint() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            yield key >> 3, data[at : at + size]
            at += size


class Normaliser:
    """The normaliser that a model file describes."""

    def __init__(self, model: bytes):
        spec = next((v for k, v in _fields(model) if k == 3), b"")
        found = dict(_fields(spec))
        self.dummy_prefix, self.squeeze, self.escape = (bool(found.get(k, 1)) for k in (3, 4, 5))
        blob = found.get(2, b"")
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = struct.unpack(f"<{size // 4}I", blob[4 : 4 + size])
        self.replacements = blob[4 + size :]

    @property
    def plain(self) -> bool:
        """Nothing but the dummy prefix and the space mark changes a text."""
        return not self.units and not self.squeeze and self.escape and self.dummy_prefix

    def longest_prefix(self, data: bytes, at: int) -> tuple[bytes, int]:
        """What the longest known prefix at a place becomes, and its length; else one character."""
        best, where = 0, -1
        if self.units:
            node = self._offset(self.units[0])
            for k in range(at, len(data)):
                node ^= data[k]
                unit = self.units[node] if node < len(self.units) else 0
                if unit & 0x800000FF != data[k]:
                    break
                node ^= self._offset(unit)
                if unit >> 8 & 1:
                    best, where = k + 1 - at, self.units[node] & 0x7FFFFFFF
        if best:
            return self.replacements[where : self.replacements.index(b"\0", where)], best
        lead = data[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return data[at : at + size], size

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def apply(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and the source byte of each (and of their end)."""
        if self.plain:
            if not data:
                return b"", np.zeros(1, np.int64)
            source = np.frombuffer(data, np.uint8)
            width = np.where(source == 32, len(MARK), 1)
            align = np.concatenate([np.zeros(len(MARK), np.int64), np.repeat(np.arange(len(source)), width), [len(source)]])
            return MARK + data.replace(b" ", MARK), align
        space = MARK if self.escape else b" "
        out, align, at = bytearray(), [], 0

        def put(piece: bytes, source: int) -> None:
            out.extend(piece)
            align.extend([source] * len(piece))

        if self.squeeze:
            while at < len(data):
                text, size = self.longest_prefix(data, at)
                if text.strip(b" "):
                    break
                at += size
        if self.dummy_prefix and at < len(data):
            put(space, at)
        after_space = self.squeeze
        while at < len(data):
            text, size = self.longest_prefix(data, at)
            if self.squeeze and after_space:
                text = text.lstrip(b" ")
            for k in text:
                put(space if k == 32 else bytes([k]), at)
            if text:
                after_space = text.endswith(b" ")
            at += size
        end = len(data)
        if self.squeeze:
            while out.endswith(space) and out:
                del out[-len(space) :]
                end = align[-len(space)]
                del align[-len(space) :]
        return bytes(out), np.array([*align, end], np.int64)


class PieceCodec:
    """A model with its normaliser; one for each task."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as f:
            model = f.read()
        self.library = SentencePieceProcessor(model_proto=model)
        self.normaliser = Normaliser(model)
        n = self.library.vocab_size()
        self.size = np.array([1 if self.library.is_byte(k) else 0 if self.library.is_control(k) else len(self.library.id_to_piece(k).encode()) for k in range(n)], np.int64)
        self.unknown = self.library.unk_id()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, with begin and end ids."""
        return [np.array(ids, "<u4") for ids in self.library.encode(texts, add_bos=True, add_eos=True, num_threads=1)]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.library.decode([x.tolist() for x in ids], num_threads=1)

    def spans(self, text: str, ids: np.ndarray) -> np.ndarray:
        """For every id the first source byte and the one after its last (begin and end ids: empty)."""
        data = text.encode()
        normal, align = self.normaliser.apply(data)
        size = self.size[ids]
        if self.unknown in ids[1:-1]:
            size[1:-1] = [len(p.encode()) if k == self.unknown else n for k, n, p in zip(ids[1:-1], size[1:-1], self.library.encode(text, out_type=str))]
        ends = np.cumsum(size)
        if len(ends) and ends[-1] != len(normal):
            raise ValueError("the pieces do not cover the normalised text")
        return np.stack([align[ends - size], align[ends]], axis=1)


def _each(path: str, column: str, make):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(path)
        for batch in batches:
            for part, _, _ in text_slices(batch, column):
                for at in range(0, part.num_rows, TEXTS):
                    rows = part.slice(at, TEXTS)
                    texts = [t or "" for t in rows.column(column).to_pylist()]
                    yield make(codec, rows, texts, codec.encode(texts))

    return run


def encode(docs: DataFrame, model: str, text_column: str = "text") -> DataFrame:
    """All columns and ``pieces``: an array of (id, begin, end), spans in bytes of the text.

    A column of that name that is there already stays; the new one then ends in ``_``.
    """
    name = free_name(docs, "pieces")
    schema = docs.sparkSession.createDataFrame([], docs.schema).selectExpr("*", f"cast(null as array<struct<id:int,begin:int,end:int>>) as `{name}`").schema
    kind = pa.list_(pa.struct([("id", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())]))

    def make(codec, rows, texts, ids):
        spans = [codec.spans(t, x) for t, x in zip(texts, ids)]
        flat = np.concatenate(spans) if spans else np.zeros((0, 2), np.int64)
        items = pa.StructArray.from_arrays([pa.array(np.concatenate(ids), pa.int32()), pa.array(flat[:, 0], pa.int32()), pa.array(flat[:, 1], pa.int32())], fields=list(kind.value_type))
        return with_new(rows, name, pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(x) for x in ids])), pa.int32()), items))

    return docs.mapInArrow(_each(model, text_column, make), schema)


def with_new(rows: pa.RecordBatch, name: str, array: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*rows.columns, array], [*rows.schema.names, name])


def decode(encoded: DataFrame, model: str, pieces_column: str = "pieces") -> DataFrame:
    """All columns and ``decoded``, the library's text of the ids (null for null)."""
    name = free_name(encoded, "decoded")
    schema = encoded.sparkSession.createDataFrame([], encoded.schema).selectExpr("*", f"cast(null as string) as `{name}`").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                rows = batch.slice(at, TEXTS)
                found = [None if p is None else codec.library.decode([x["id"] for x in p]) for p in rows.column(pieces_column).to_pylist()]
                yield with_new(rows, name, pa.array(found, pa.string()))

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document what encoding and decoding give, as digests, in one pass.

    n_tokens and ids_sha256 of the ids, decoded_sha256 of the decoded text, and
    spans_sha256 of the pieces' byte spans (little-endian 32-bit begin, end).
    """

    def make(codec, rows, texts, ids):
        sha = lambda data: hashlib.sha256(data).hexdigest()
        return pa.RecordBatch.from_arrays(
            [
                rows.column(id_column),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([sha(x.tobytes()) for x in ids]),
                pa.array([sha(t.encode()) for t in codec.decode(ids)]),
                pa.array([sha(codec.spans(t, x).astype("<u4").tobytes()) for t, x in zip(texts, ids)]),
            ],
            [id_column, "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"],
        )

    bounded_batches(docs.sparkSession)
    rows = docs.select(id_column, text_column)
    return rows.mapInArrow(_each(model, text_column, make), f"`{id_column}` {dict(rows.dtypes)[id_column]}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_sha256 string")
