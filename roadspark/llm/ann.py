"""Approximate nearest neighbours by a hierarchical k-means tree (op 9).

The tree is fitted on a sample that grows with the root of the table (16 * sqrt(rows), between
SAMPLE and MAX_SAMPLE vectors, and SAMPLE_BYTES of them at most), so that leaves grow in number and not only in size; then
every vector gets its leaf. A
search walks the tree best bin first: a priority queue holds the branches met so far by the
distance of their centres, the nearest is opened next, and a leaf that is popped is visited.
How many leaves a query visits is calibrated: for QUERIES_TRIED sample queries the true
neighbours among all vectors are found, and visits widen until they hold TARGET of them.

Nearness is the inner product in double precision. Centres live in a space with one more
dimension, sqrt(M^2 - |x|^2) with M the largest norm, where the largest inner product is the
smallest distance. The vectors of a shelf of leaves and the queries that visit some of them
meet in cells of bounded size, whatever a leaf holds; a query meets a leaf's vectors only if
it visits the leaf. Each cell keeps the best k of a query, and a window joins them.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do
null ids. Vectors of one dimension search among themselves, each dimension with a tree of its
own (more than MAX_DIMENSIONS are an error). Every row is a candidate of every other row, rows
that repeat an id or a vector too; only a query's own row is none of its own. Of equal query
rows (id and vector) one searches. A query id has ranks from 1 for each of its different
vectors. Equal scores rank by the smaller id. Fewer candidates than k are all returned. Empty
tables give empty tables.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import received, saved, ship

#: Bounds on the vectors that the tree is fitted on.
SAMPLE, MAX_SAMPLE = 8192, 131_072
#: Bound on the sample's bytes, whatever the dimensions; the driver holds it a few times over.
SAMPLE_BYTES = 64 << 20
#: Bound on the dimensions that are told apart.
MAX_DIMENSIONS = 16
BRANCHES = 16
#: Nodes with fewer sample vectors are leaves.
LEAF_SAMPLE = 64
ROUNDS = 8
QUERIES_TRIED = 128
TARGET = 0.95
#: Leaves whose vectors share a cell.
SHELF = 16
#: Vectors and queries of a cell, about.
CELL_VECTORS, CELL_QUERIES = 20_000, 4_000


class Tree:
    """Centres and children of all nodes; a node without children is a leaf."""

    def __init__(self, points: np.ndarray, radius: float, seed: int = 9):
        self.radius = radius
        lifted = self.lift(points)
        self.centres, self.children, self.leaf = [lifted.mean(0) if len(lifted) else np.zeros(points.shape[1] + 1)], [[]], [0]
        self.n_leaves = 0
        rng = np.random.default_rng(seed)
        work = [(0, lifted)]
        while work:
            node, own = work.pop()
            groups = _k_means(own, BRANCHES, rng) if len(own) >= LEAF_SAMPLE else []
            if len(groups) < 2:
                self.leaf[node] = self.n_leaves
                self.n_leaves += 1
                continue
            for centre, members in groups:
                self.children[node].append(len(self.centres))
                self.centres.append(centre)
                self.children.append([])
                self.leaf.append(-1)
                work.append((len(self.centres) - 1, members))
        self.centres = np.array(self.centres)

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([x, np.sqrt(np.maximum(self.radius**2 - (x**2).sum(1), 0))])

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down the nearest centres."""
        lifted, out = self.lift(x), np.zeros(len(x), np.int32)
        work = [(0, np.arange(len(x)))]
        while work:
            node, rows = work.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
                continue
            near = _distances(lifted[rows], self.centres[below]).argmin(1)
            work += [(child, rows[near == k]) for k, child in enumerate(below) if (near == k).any()]
        return out

    def visit(self, query: np.ndarray, count: int) -> list[int]:
        """The first leaves of a best-bin-first walk."""
        lifted = np.append(query, 0.0)
        queue, found = [(0.0, 0)], []
        while queue and len(found) < count:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                found.append(self.leaf[node])
                continue
            for distance, child in zip(((self.centres[below] - lifted) ** 2).sum(1), below):
                heapq.heappush(queue, (float(distance), child))
        return found


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances up to a term of the rows."""
    return (centres**2).sum(1) - 2 * (x @ centres.T)


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        near = _distances(x, centres).argmin(1)
        kept = np.unique(near)
        centres = np.array([x[near == j].mean(0) for j in kept])
    near = _distances(x, centres).argmin(1)
    return [(centres[j], x[near == j]) for j in np.unique(near)]


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def best(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best of some vectors: the query's row, their rows, ids, scores; never its own row.

    A matrix product preselects; what may be among the best is scored again row by row, so
    equal vectors have equal scores wherever they are stored.
    """
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for at in range(0, len(queries), 128):
        some, some_rows = queries[at : at + 128], own[at : at + 128]
        rough = some @ vectors.T
        rough[some_rows[:, None] == rows[None, :]] = -np.inf
        for q, row, near in zip(some, some_rows, rough):
            least = np.partition(near, -k)[-k] if len(near) > k else -np.inf
            may = np.flatnonzero((near >= least - 1e-9 * (1 + abs(least))) if np.isfinite(least) else np.isfinite(near))
            score = (vectors[may] * q).sum(1)
            order = np.lexsort((rows[may], ids[may], -score))[:k]
            found.append((np.full(len(order), row, np.int64), rows[may][order], ids[may][order], score[order]))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def usable(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """The vectors that take part: id, v (array of double)."""
    v = F.col(vector_column).cast("array<double>")
    rows = table.select(F.col(id_column).cast("bigint").alias("id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def build(rows: DataFrame) -> Tree:
    """Fit the tree on a bounded sample of usable vectors."""
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, radius, dimensions = rows.agg(F.count("*"), F.max(F.sqrt(norm)), F.max(F.size("v"))).first()
    size = int(min(MAX_SAMPLE, max(SAMPLE, 16 * np.sqrt(n)), max(1, SAMPLE_BYTES // (8 * (dimensions or 1)))))
    share = min(1.0, 0.9 * size / max(1, n))
    sample = rows.where(F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1 << 30)) < int(share * (1 << 30))).limit(size).toArrow()
    points = _matrix(sample.column("v").combine_chunks()) if sample.num_rows else np.zeros((0, 1))
    return Tree(points[np.lexsort((*points.T[::-1], sample.column("id").to_numpy()))], radius or 1.0)  # whatever the order of arrival


def _placed(rows: DataFrame, tree: Tree) -> DataFrame:
    """row (its own number), id, v, leaf of every vector; saved, so that the numbers stay."""
    shared = ship(rows.sparkSession, tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(Tree, shared)
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.place(_matrix(batch.column(1))))], ["id", "v", "leaf"])

    placed = rows.mapInArrow(run, "id bigint, v array<double>, leaf int")
    return saved(placed.select(F.monotonically_increasing_id().alias("row"), "id", "v", "leaf"), "leaves")


def calibrate(placed: DataFrame, tree: Tree, queries: Column, k: int) -> int:
    """Leaves to visit so that tried queries find TARGET of their true neighbours."""
    n = placed.where(queries).count()
    if not n:
        return 1
    share = min(1.0, 0.9 * QUERIES_TRIED / n)
    tried = placed.where(queries & (F.pmod(F.xxhash64("id", F.lit(99)), F.lit(1 << 30)) < int(share * (1 << 30)))).select("row", "v").limit(QUERIES_TRIED).collect()
    if not tried:
        return tree.n_leaves
    own, points = np.array([r[0] for r in tried]), np.array([r[1] for r in tried], float)
    shared = placed.sparkSession.sparkContext.broadcast((points, own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, own = shared.value
        for batch in batches:
            if batch.num_rows:
                rows, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                q, row, v, s = best(points, own, _matrix(batch.column(2)), rows, ids, k)
                order = np.argsort(rows, kind="stable")
                leaf = batch.column(3).to_numpy()[order][np.searchsorted(rows[order], row)]
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s), pa.array(leaf)], ["q", "v", "s", "leaf"])

    window = Window.partitionBy("q").orderBy(F.desc("s"), "v")
    true = placed.mapInArrow(run, "q bigint, v bigint, s double, leaf int").withColumn("r", F.row_number().over(window)).where(F.col("r") <= k).select("q", "leaf").collect()
    place = {int(i): {leaf: at for at, leaf in enumerate(tree.visit(p, tree.n_leaves))} for i, p in zip(own, points)}
    needed = np.sort([place[r[0]][r[1]] + 1 for r in true])
    return int(needed[min(len(needed) - 1, int(np.ceil(TARGET * len(needed))) - 1)]) if len(needed) else tree.n_leaves


def search(table: DataFrame, queries: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, id_column, score: the k nearest found of every row of ``table`` that
    ``queries`` (a condition on its column ``id``) selects, among all other rows."""
    rows = usable(table, id_column, vector_column)
    sizes = [r[0] for r in rows.groupBy(F.size("v").alias("d")).agg(F.max(queries).alias("asked")).where("asked").orderBy("d").limit(MAX_DIMENSIONS + 1).collect()]
    if len(sizes) > MAX_DIMENSIONS:
        raise ValueError(f"vectors of more than {MAX_DIMENSIONS} dimensions")
    parts = [_search(rows.where(F.size("v") == d), queries, k) for d in sizes]
    found = reduce(DataFrame.unionByName, parts) if parts else table.sparkSession.createDataFrame([], "query_id bigint, rank int, v bigint, score double")
    return found.withColumnRenamed("v", id_column)


def _search(rows: DataFrame, queries: Column, k: int) -> DataFrame:
    tree = build(rows)
    placed = _placed(rows, tree)
    visits = calibrate(placed, tree, queries, k)
    shared = ship(rows.sparkSession, tree)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(Tree, shared)
        for batch in batches:
            if batch.num_rows:
                rows, shelves, leaves = [], [], []
                for row, q in enumerate(_matrix(batch.column(2))):
                    found = np.sort(np.array(own.visit(q, visits)))
                    for part in np.split(found, np.flatnonzero(np.diff(found // SHELF)) + 1):
                        rows.append(row)
                        shelves.append(part[0] // SHELF)
                        leaves.append(part)
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns), pa.array(shelves, pa.int32()), pa.array(leaves, pa.list_(pa.int32()))], ["row", "id", "v", "shelf", "leaves"])

    # Cells: a shelf's vectors in blocks, the queries that visit it in chunks. Both numbers
    # follow what the shelf itself holds and who visits it.
    shelf = F.floor(F.col("leaf") / SHELF).cast("int")
    wanted = placed.where(queries).groupBy("id", "v").agg(F.min("row").alias("row")).select("row", "id", "v")
    visited = saved(wanted.mapInArrow(walk, "row bigint, id bigint, v array<double>, shelf int, leaves array<int>"), "visits")
    shelves = range(-(-tree.n_leaves // SHELF))

    def parts_of(sizes: DataFrame, bound: int) -> Column:
        known = {r[0]: r[1] for r in sizes.groupBy("shelf").count().collect()}  # at most a row for each shelf of the tree
        return F.element_at(F.create_map(*[F.lit(x) for n in shelves for x in (n, max(1, -(-known.get(n, 0) // bound)))]), F.col("shelf"))

    blocks, chunks = parts_of(placed.select(shelf.alias("shelf")), CELL_VECTORS), parts_of(visited.select("shelf"), CELL_QUERIES)
    every = lambda n: F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))
    dealt = lambda n: F.pmod(F.xxhash64("row"), n).cast("int")
    vectors = placed.withColumn("shelf", shelf).select("shelf", dealt(blocks).alias("block"), every(chunks).alias("chunk"), "row", "id", "v", "leaf")
    asked = visited.select("shelf", every(blocks).alias("block"), dealt(chunks).alias("chunk"), "row", "id", "v", "leaves")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        ids = np.zeros(0, np.int64)
        if left.num_rows and right.num_rows:
            x, y = (_matrix(t.column("v").combine_chunks()) for t in (left, right))
            asks, ids = left.column("row").to_numpy(), left.column("id").to_numpy()
            rows, names, leaf = (right.column(c).to_numpy() for c in ("row", "id", "leaf"))
            lists = left.column("leaves").combine_chunks()
            visitor, visit = np.repeat(np.arange(len(asks)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
            for one in np.unique(leaf):
                some, has = visitor[visit == one], np.flatnonzero(leaf == one)
                found.append(best(x[some], asks[some], y[has], rows[has], names[has], k))
        q, row, v, s = (np.concatenate(parts) for parts in zip(*found))
        order = np.lexsort((row, v, -s, q))
        q, v, s = q[order], v[order], s[order]
        first = np.flatnonzero(np.append(True, q[1:] != q[:-1]))[: len(q)]
        keep = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q)))) < k
        q = q[keep]
        name = ids[np.argsort(asks)][np.searchsorted(np.sort(asks), q)] if len(q) else q
        return pa.table({"q": q, "id": name, "v": v[keep], "s": s[keep]})

    cell = ["shelf", "block", "chunk"]
    met = asked.groupBy(*cell).cogroup(vectors.groupBy(*cell)).applyInArrow(meet, "q bigint, id bigint, v bigint, s double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "v"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("id").alias("query_id"), "rank", "v", F.col("s").alias("score"))
