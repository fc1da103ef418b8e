"""URL rules by a Bloom filter cascade (op 3).

A rule is a host and a path; it fits a url of that host or a subdomain whose path starts with
the rule's. A url's keys are the host suffixes and path prefixes that rules of any shape
could have. The cascade's first level encodes the listed keys; the next one those keys of
the whole corpus that pass the first without being listed; the next the listed keys that
pass both; and so on until no key is left. Over the corpus's keys membership is then exact,
and a page is judged from its own keys and a few bit arrays, without a join. A second,
smaller cascade over the listed keys tells blocked from allowed.

Keys are hashed twice, by functions that do not depend on each other. Should levels stop
shrinking all the same (keys with two equal hashes), the few keys that are left are compared
as text, so the cascade ends and stays exact whatever the hashes are.

The bit arrays take about log2(keys / rules) bits a rule, so their size follows the list;
MAX_BITS bounds what is broadcast, and a longer list is an error.

Null urls and urls without ``://`` have empty host and path and no rule. Urls without a rule
get the method's verdict, ``allow``. Of rules with one key ``block`` wins. Repeated rows and
null ids pass through; empty tables and empty rule lists are fine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LETTERS, free_name, saved
from .words import mix

MAX_BITS = 1 << 31
#: Keys that may be left to compare as text; more are an error.
MAX_LEFT = 10_000
_U = np.uint64


class Level:
    """One Bloom filter: its size, its number of probes, its bits."""

    def __init__(self, number: int, count: int, rate: float):
        self.number = number
        self.probes = max(1, math.ceil(math.log2(1 / rate)))
        self.bits = max(64, math.ceil(max(1, count) * math.log2(1 / rate) / math.log(2)))
        if self.bits > MAX_BITS:
            raise ValueError("the list is too long for one broadcast filter")
        self.words = np.zeros(-(-self.bits // 64), np.uint64)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Bit places of each key, from its two hashes."""
        first, second = mix(hashes[:, 0] ^ _U(self.number * 0x9E3779B9)), mix(hashes[:, 1] + _U(self.number)) | _U(1)
        return (first[:, None] + second[:, None] * np.arange(self.probes, dtype=np.uint64)) % _U(self.bits)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = self.places(hashes)
        return (self.words[at >> _U(6)] >> (at & _U(63)) & _U(1)).all(1)


class Left:
    """The last level where filters no longer tell keys apart: the listed keys themselves."""

    def __init__(self, number: int, keys: list[str]):
        self.number, self.keys = number, set(keys)


def member(levels: list, hashes: np.ndarray, keys: pa.Array) -> np.ndarray:
    """Is each key listed? The first level that lacks a key decides by its number."""
    found, open_ = np.zeros(len(hashes), bool), np.arange(len(hashes))
    for level in levels:
        if not len(open_):
            return found
        if isinstance(level, Left):
            # What this level encodes passed it; anything else did not.
            held = np.array([k in level.keys for k in keys.take(pa.array(open_)).to_pylist()], bool)
        else:
            held = level.holds(hashes[open_])
        found[open_[~held]] = level.number % 2 == 1
        open_ = open_[held]
    found[open_] = len(levels) % 2 == 1
    return found


def _hashes(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in (1, 2)])


def hashes_of(key: Column) -> tuple[Column, Column]:
    """Two hashes of a key; the second starts from a state of its own."""
    return F.xxhash64(key), F.xxhash64(F.lit(1), key)


def hashed(keys: DataFrame) -> DataFrame:
    h1, h2 = hashes_of(F.col("key"))
    return keys.withColumns({"h1": h1, "h2": h2})


def cascade(listed: DataFrame, others: DataFrame) -> list:
    """The levels for keys ``listed`` against ``others`` (both: key, h1, h2; no key in both)."""
    spark = listed.sparkSession
    n, m = listed.count(), others.count()
    levels: list = []
    inside, outside = listed, others
    before = None
    while n:
        if before == (n, m):
            # Neither side shrank in its last turn: their hashes are equal.
            keys = [r[0] for r in inside.select("key").limit(MAX_LEFT + 1).collect()]
            if len(keys) > MAX_LEFT:
                raise ValueError("too many keys with equal hashes")
            levels.append(Left(len(levels), keys))
            break
        before = (m, n)
        rate = 0.5 if levels else min(0.5, max(1e-9, n * math.sqrt(0.5) / max(1, m)))
        level = Level(len(levels), n, rate)

        def bits(batches: Iterator[pa.RecordBatch], level=level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = level.places(_hashes(batch)).ravel()
                order = np.argsort(at)
                at = at[order]
                word = (at >> _U(6)).astype(np.int64)
                first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))[: len(word)]
                mask = np.bitwise_or.reduceat(_U(1) << (at & _U(63)), first) if len(word) else at
                yield pa.RecordBatch.from_arrays([pa.array(word[first]), pa.array(mask.view(np.int64))], ["word", "mask"])

        # At most a row for each 64 bits of the filter, whose size is checked above.
        found = inside.mapInArrow(bits, "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
        level.words[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
        levels.append(level)
        if not m:
            break
        shared = spark.sparkContext.broadcast(level.words)

        def passing(batches: Iterator[pa.RecordBatch], level=level, shared=shared) -> Iterator[pa.RecordBatch]:
            level.words = shared.value
            for batch in batches:
                yield batch.filter(pa.array(level.holds(_hashes(batch))))

        words, level.words = level.words, None  # the closure carries no bits
        passed = saved(outside.mapInArrow(passing, "key string, h1 bigint, h2 bigint"), "passed")
        level.words = words
        inside, outside, n, m = passed, inside, passed.count(), n
    return levels


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, k), F.lit("")) for k in (1, 2))
    return F.translate(host, LETTERS, LETTERS.lower()), path


def candidate_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """The keys that rules of these numbers of host labels and path lengths could match."""
    count = F.size(F.split(host, r"\."))
    found = [F.when((host != "") & (count >= n) & (F.length(path) >= size), F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, size))) for n in labels for size in lengths]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def judge(pages: DataFrame, rules: DataFrame, url_column: str = "url", default: str = "allow") -> tuple[DataFrame, list[str]]:
    """All columns of ``pages``, host, path, rule and verdict; the four names are returned too.

    ``rules`` has the columns host, path and verdict (allow or block).
    """
    spark = pages.sparkSession
    listed = rules.select(F.concat("host", "path").alias("key"), F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("size"), "verdict").where("key is not null")
    shapes = listed.select("labels", "size").distinct().collect()
    labels, lengths = sorted({r[0] for r in shapes}), sorted({r[1] for r in shapes})
    host, path, rule, verdict, keys, one, two, hit, bad = (free_name(pages, x) for x in ("host", "path", "rule", "verdict", "keys", "hash1", "hash2", "hit", "bad"))
    h, p = host_and_path(F.col(url_column))
    rows = pages.withColumns({host: h, path: p})
    rows = rows.withColumn(keys, candidate_keys(F.col(host), F.col(path), labels, lengths))

    by_key = listed.groupBy("key").agg(F.max(F.col("verdict") == "block").alias("blocked"))
    all_keys = saved(hashed(by_key).select("key", "h1", "h2", "blocked"), "listed")
    universe = hashed(rows.select(F.explode(keys).alias("key")).distinct())
    others = saved(universe.join(all_keys, "key", "left_anti"), "universe")
    known = cascade(all_keys.drop("blocked"), others)
    block = cascade(all_keys.where("blocked").drop("blocked"), all_keys.where("not blocked").drop("blocked"))
    shared = spark.sparkContext.broadcast([[(isinstance(x, Left), vars(x)) for x in levels] for levels in (known, block)])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def level(last, values):
            kind = Left if last else Level
            out = kind.__new__(kind)
            out.__dict__ = values
            return out

        known, block = ([level(*x) for x in levels] for levels in shared.value)
        for batch in batches:
            lists, texts = batch.column(one), batch.column(keys).flatten()
            flat = np.column_stack([batch.column(c).flatten().to_numpy(zero_copy_only=False).view(np.uint64) for c in (one, two)])
            hits, blocked = (pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))), pa.int32()), pa.array(member(levels, flat, texts))) for levels in (known, block))
            keep = [k for k, c in enumerate(batch.schema.names) if c not in (one, two)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), hits, blocked], [*(batch.schema.names[k] for k in keep), hit, bad])

    probes = rows.withColumns({one: F.transform(keys, lambda k: hashes_of(k)[0]), two: F.transform(keys, lambda k: hashes_of(k)[1])})
    schema = rows.sparkSession.createDataFrame([], rows.schema).selectExpr("*", f"cast(null as array<boolean>) as `{hit}`", f"cast(null as array<boolean>) as `{bad}`").schema
    tested = probes.mapInArrow(test, schema)
    fits = F.filter(F.arrays_zip(F.col(keys).alias("key"), F.col(hit).alias("hit"), F.col(bad).alias("bad")), lambda x: x["hit"])
    longest = F.array_max(F.transform(fits, lambda x: F.struct(F.length(x["key"]).alias("size"), x["key"].alias("key"), x["bad"].alias("bad"))))
    out = tested.withColumn(hit, longest).withColumns({rule: F.col(f"{hit}.key"), verdict: F.when(F.col(hit).isNull(), F.lit(default)).when(F.col(f"{hit}.bad"), F.lit("block")).otherwise(F.lit("allow"))})
    return out.drop(hit, bad, keys), [host, path, rule, verdict]
