"""Hard negatives by slot-decomposed selection (op 11).

An anchor's positives are the best rows of its own label. Each positive sets an upper limit, so
many hundredths of its score, that a negative of it may reach at most. An anchor's limits, in
descending order, cut the scores of all other rows into disjoint slots: slot 0 ends at the
highest limit, and each following limit ends the one before. What a positive may take is then
the union of its own slot and all lower ones, whatever other windows overlap it. So each task
keeps the best few of every slot of every anchor (a combiner), the slots of an anchor meet once,
and as they are in descending order of score, merging a suffix of slots is taking the first few
rows from the positive's slot on; its lower limit then cuts off the end.

Anchors are a stated set of rows. They are broadcast in blocks of at most BLOCK_BYTES, and
each block reads the table twice, once for positives and once for negatives; vectors are never
shuffled or copied, only the few best rows of a task are. Every row is scored against every
anchor, exactly; there is no index and nothing is approximate.

Scores are integer inner products of floor(scale * x). They are computed in doubles where no
partial sum can pass 2^53, else in integers of any length; components and scores beyond 64 bits
are kept at the ends of their range. Rows of different dimensions do not meet.

Rows with a null id, label or vector, or a null or non-finite component, take no part. Every
row counts by itself: rows that repeat an id, or everything, are candidates of each other, and
each of them that is an anchor has results of its own. Equal scores rank by the smaller id; of
rows with equal id and score it does not matter which comes first. An anchor without positives,
and a positive without negatives in its window, has no rows. Columns of the table other than the
three named play no part. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, received, saved, ship

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 50, 95
#: Bound on the vectors of one block of anchors.
BLOCK_BYTES = 16 << 20
#: Scores that a task holds at a time.
SCORES = 1 << 22
_EXACT, _LONG = 1 << 53, 1 << 63


def scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of two arrays of whole-numbered doubles."""
    if x.shape[1] * float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) < _EXACT:
        return (x @ y.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in z], object).reshape(z.shape) for z in (x, y)]
    exact = [[int((a * b).sum()) if len(a) else 0 for b in whole[1]] for a in whole[0]]
    return np.clip(np.array(exact, object).reshape(len(x), len(y)), 1 - _LONG, _LONG - 1).astype(np.int64)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    some = np.arange(len(score))
    if len(score) > k:
        some = np.flatnonzero(score >= np.partition(score, -k)[-k])
    return some[np.lexsort((ids[some], -score[some]))[:k]]


class Anchors:
    """A block of anchors: their rows, and what each of them looks for.

    ``ends`` holds an anchor's limits, descending: slot j is what lies below its j-th limit
    and above the next one, or at or above ``floors`` in the last slot. Without limits there is
    one slot without an end, for positives.
    """

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray], ends: list[list[int]] | None = None, floors: list[int] | None = None):
        sizes = np.array([len(v) for v in vectors], np.int64)
        self.rows, self.ids, self.labels, self.ends, self.floors = rows, ids, labels, ends, floors
        self.by_size = {int(d): (own := np.flatnonzero(sizes == d), np.array([vectors[k] for k in own], float).reshape(len(own), d)) for d in np.unique(sizes)}


class _Slots:
    """The best k of each slot of each anchor among the rows met so far."""

    def __init__(self, anchors: Anchors, k: int):
        self.anchors, self.k = anchors, k
        slots = 1 if anchors.ends is None else max(map(len, anchors.ends), default=1)
        self.count = np.zeros((len(anchors.rows), slots), np.int32)
        self.score, self.id = (np.zeros((len(anchors.rows), slots, k), np.int64) for _ in range(2))

    def add(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        own, points = self.anchors.by_size.get(vectors.shape[1], (np.zeros(0, np.int64), None))
        step = max(1, SCORES // max(1, len(rows)))
        for first in range(0, len(own), step):
            for a, score in zip(own[first : first + step], scores(points[first : first + step], vectors)):
                same = labels == self.anchors.labels[a]
                if self.anchors.ends is None:
                    self.keep(a, 0, np.flatnonzero(same & (rows != self.anchors.rows[a])), score, ids)
                    continue
                ends = self.anchors.ends[a]
                some = np.flatnonzero(~same & (score <= ends[0]) & (score >= self.anchors.floors[a]))
                # The number of limits that a score does not pass, less one, is its slot.
                slot = len(ends) - 1 - np.searchsorted(ends[::-1], score[some])
                for j in range(len(ends)):
                    self.keep(a, j, some[slot == j], score, ids)

    def keep(self, anchor: int, slot: int, some: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(some):
            return
        some = some[best(score[some], ids[some], self.k)]
        n = self.count[anchor, slot]
        s, v = np.append(self.score[anchor, slot, :n], score[some]), np.append(self.id[anchor, slot, :n], ids[some])
        first = best(s, v, self.k)
        self.count[anchor, slot] = n = len(first)
        self.score[anchor, slot, :n], self.id[anchor, slot, :n] = s[first], v[first]

    def batch(self) -> pa.RecordBatch:
        anchor, slot, at = np.nonzero(np.arange(self.k) < self.count[:, :, None])
        columns = [self.anchors.rows[anchor], self.anchors.ids[anchor], slot.astype(np.int32), self.id[anchor, slot, at], self.score[anchor, slot, at]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "anchor_id", "slot", "id", "score"])


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places and vectors of a batch's rows, for each number of dimensions."""
    lists = batch.column("v")
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for d in np.unique(sizes):
        own = np.flatnonzero(sizes == d)
        yield own, flat[offsets[own][:, None] + np.arange(d)].reshape(len(own), d)


def _selected(rows: DataFrame, shared, k: int) -> DataFrame:
    """row and anchor_id of the anchor, slot, id, score: what each task keeps of each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _Slots(received(Anchors, shared), k)
        for batch in batches:
            numbers, ids, labels = (batch.column(c).to_numpy() for c in ("row", "id", "label"))
            for own, vectors in _by_dimension(batch):
                slots.add(numbers[own], ids[own], labels[own], vectors)
        yield slots.batch()

    return rows.mapInArrow(run, "row bigint, anchor_id bigint, slot int, id bigint, score bigint")


def usable(table: DataFrame, id_column: str, label_column: str, vector_column: str) -> DataFrame:
    """row (its own number), id, label, v (whole numbers) of the rows that take part; saved, so
    that the numbers stay."""
    v = F.col(vector_column).cast("array<double>")
    rows = table.select(F.col(id_column).cast("bigint").alias("id"), F.col(label_column).cast("bigint").alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    whole = F.transform("v", lambda x: F.floor(x * SCALE).cast("double"))  # the floor is a bigint, at its end for a larger value
    return saved(rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", whole.alias("v")), "vectors")


def _blocks(anchors: DataFrame, block_bytes: int) -> Iterator[pa.Table]:
    """The anchors in blocks of a bounded size, one after the other."""
    total = anchors.agg(F.coalesce(F.sum(F.size("v") * 8 + 24), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks))
    while blocks > 1:  # the hash deals unevenly; a block of two rows or more must keep the bound
        most = anchors.groupBy(block.alias("b")).agg(F.sum(F.size("v") * 8 + 24).alias("s"), F.count("*").alias("n")).where("n > 1").agg(F.max("s")).first()[0]
        if (most or 0) <= 2 * block_bytes:
            break
        blocks *= 2
        block = F.pmod(F.xxhash64("row"), F.lit(blocks))
    for k in range(blocks):
        found = anchors.where(block == k).toArrow()
        if found.num_rows:
            yield found


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(table: DataFrame, anchors: Column, id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on the column ``id``. For each anchor and each of its best
    ``positives`` rows of the same label: the first ``negatives`` rows of other labels with
    least * positive_score <= 100 * negative_score <= most * positive_score.
    """
    spark = table.sparkSession
    bounded_batches(spark)
    rows = usable(table, id_column, label_column, vector_column)
    parts = [_mined(rows, block, positives, negatives, least, most) for block in _blocks(rows.where(anchors), block_bytes)]
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _hundredths(times: int, score: str, up: bool = False) -> str:
    """times * score / 100 of a score from 0 on as SQL, rounded down or up, without overflow."""
    return f"(cast({score} as decimal(20,0)) * {times} + {99 if up else 0}) div 100"


def _mined(rows: DataFrame, block: pa.Table, positives: int, negatives: int, least: int, most: int) -> DataFrame:
    spark = rows.sparkSession
    own, ids, labels = (block.column(c).to_numpy() for c in ("row", "id", "label"))
    lists = block.column("v").combine_chunks()
    vectors = np.split(lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()[1:-1])
    # A row for each anchor of the block and each of its positives: bounded as the block is.
    # Below a score of 0 no window holds anything.
    near = _ranked(_selected(rows, ship(spark, Anchors(own, ids, labels, vectors)), positives), ["row"], positives).where("score >= 0")
    limits = {"limit": F.expr(_hundredths(most, "score")), "floor": F.expr(_hundredths(least, "score", True))}
    near = saved(near.select("row", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), *[c.alias(n) for n, c in limits.items()]), "positives")
    known = near.groupBy("row").agg(F.sort_array(F.collect_set("limit"), asc=False).alias("ends"), F.min("floor").alias("floor"))
    limited = known.toArrow()
    place = {int(r): k for k, r in enumerate(limited.column("row").to_numpy())}
    ends, floors = limited.column("ends").to_pylist(), limited.column("floor").to_pylist()
    asked = [k for k, r in enumerate(own) if int(r) in place]
    at = [place[int(own[k])] for k in asked]
    seek = Anchors(own[asked], ids[asked], labels[asked], [vectors[k] for k in asked], [ends[k] for k in at], [floors[k] for k in at])
    slots = _ranked(_selected(rows, ship(spark, seek), negatives), ["row", "slot"], negatives)
    # An anchor's slots: at most positives * negatives rows, in descending order.
    found = slots.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("slot", (-F.col("score")).alias("down"), "id"))).alias("found"))
    wanted = near.join(known.select("row", "ends"), "row").join(found, "row")
    suffix = F.slice(F.filter("found", lambda x: x["slot"] >= F.array_position("ends", F.col("limit")) - 1), 1, negatives)
    named = wanted.select("anchor_id", "positive_id", "positive_score", "floor", F.posexplode(suffix).alias("at", "x"))
    inside = named.where(-F.col("x.down") >= F.col("floor"))
    return inside.select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("negative_id"), "positive_score", (-F.col("x.down")).alias("negative_score"))
