"""Near-duplicate documents by a chosen-path similarity join (op 7).

A document is the set of its five-word shingles; two are linked when 100 * intersection >=
75 * union. Equal sets are one vertex from the start. Each set has COORDINATES min-wise
tokens. TREES independent trees branch the vertices by selected tokens: the first branch of
a tree takes two tokens of its own, and a node that is still large branches again by tokens
that its path selects with expectation 1/0.75, so a pair at the threshold keeps a path in
every tree with a probability that does not vanish, and misses all trees with less than
1e-8 at the first level.

In every node the members are compared with the node's pivot. Nodes whose members are then
in one component need no more work; of the others, large ones branch, down to DEPTH, and
small ones are compared exhaustively by their tokens and propose a spanning forest of the
pairs with CANDIDATE equal tokens, likeliest first; so are nodes that are large even at
DEPTH, both cut into pairs of blocks of SIDE members. Pairs with the pivot and proposed pairs
are decided on the two full sets, unless their sizes rule a link out or fewer than CANDIDATE
tokens are equal. At last the pairs that are NEAR by their full sets, links or not, join documents into clusters;
where a cluster still has several components, all its pairs of different components are
compared on full sets, whatever their tokens, in tiles of bounded size.
Components grow by alternating star operations on the links, as joins and aggregates.

What can be missed is a pair that no tree's first branch brings together, or that has fewer
than CANDIDATE equal tokens (at the threshold with a probability of 5e-11), and that no
cluster brings together either.

Shingles are compared by 64-bit hashes of 64-bit hashes of words. Texts that are null or
have no words have empty sets and no links. A text of one to four words is one shingle. Rows
are judged row by row, whatever their doc_id: those that repeat one with different texts are
different vertices, and equal rows are one. Rows with a null doc_id get no component and
stay. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, bounded_batches, free_name, saved, text_slices
from .words import SPACED, mix, shingle_sets, split_words

#: Text bytes that become sets at a time.
SLICE = 1 << 20
SHINGLE = 5
#: Similarity in percent.
THRESHOLD = 75
COORDINATES = 64
TREES = 24
#: Nodes of up to so many members are compared exhaustively.
LEAF = 2048
#: Members to a side of a tile, and values of their full sets (a larger set is one side).
TILE, TILE_VALUES = 512, 2 << 20
#: Values of sets that a tile counts at a time, and columns of the product that counts them.
PART = 1 << 20
WIDTH = 4096
#: Equal coordinates of 64 that a candidate pair needs: at the threshold 48 are expected.
CANDIDATE = 24
#: Members of a block of a node that is compared exhaustively.
SIDE = 1024
#: Similarity in percent from which decided pairs join clusters.
NEAR = 50
#: Nodes that are large even so deep down are compared exhaustively.
DEPTH = 3
BLOCK = 512

_A = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix(np.arange(1001, COORDINATES + 1001, dtype=np.uint64))


def _set_rows(column: str, batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part, data, bounds in text_slices(batch, column, SLICE):
            words, word_at = split_words(data, bounds, SPACED)
            values, at = shingle_sets(words, word_at, SHINGLE)
            yield part, values, at


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, values, at in _set_rows("text", batches):
        n, full = np.diff(at), np.flatnonzero(np.diff(at))
        digests = np.zeros((2, len(n)), np.uint64)
        tokens = np.zeros((len(n), COORDINATES), np.uint32)
        if len(full):
            begin = at[:-1][full]
            digests[0, full] = np.add.reduceat(mix(values), begin)
            digests[1, full] = np.add.reduceat(mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), begin)
            for k in range(COORDINATES):
                tokens[full, k] = np.minimum.reduceat(values * _A[k] + _B[k], begin) >> np.uint64(32)
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                part.column(1),
                pa.array(n, pa.int64()),
                pa.array(digests[0].view(np.int64)),
                pa.array(digests[1].view(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * COORDINATES, pa.int32()), pa.array(tokens.view(np.int32).ravel())),
            ],
            ["id", "h", "n", "k1", "k2", "sig"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, values, at in _set_rows("text", batches):
        sets = [values[at[k] : at[k + 1]].tobytes() for k in range(part.num_rows)]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["rep", "members"])


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether pairs are links, and whether they are near, on their full sets."""
    for batch in batches:
        shares = [_shares(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(batch.column(2), batch.column(3))]
        link, near = (pa.array([100 * c >= percent * u for c, u in shares], pa.bool_()) for percent in (THRESHOLD, NEAR))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), link, near], ["a", "b", "link", "near"])


def _proposals(ids, comps, sigs, blocks, crossing: bool):
    """A spanning forest, likeliest first, of the likely pairs of a group's components."""
    for i in range(0, len(ids), BLOCK):
        for j in range(i, len(ids), BLOCK):
            x, y = slice(i, i + BLOCK), slice(j, j + BLOCK)
            wanted = comps[x, None] != comps[None, y]
            if crossing:
                wanted &= blocks[x, None] != blocks[None, y]
            if not wanted.any():
                continue
            same = np.zeros(wanted.shape, np.int16)
            for k in range(COORDINATES):
                same += sigs[x, k, None] == sigs[None, y, k]
            p, q = np.nonzero((same >= CANDIDATE) & wanted)
            # Of the pairs that join the same two components the likeliest one is enough.
            c, d = comps[i + p], comps[j + q]
            order = np.lexsort((-same[p, q], np.maximum(c, d), np.minimum(c, d)))
            low, high = np.minimum(c, d)[order], np.maximum(c, d)[order]
            order = order[np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))[: len(order)]]
            order = order[np.argsort(-same[p[order], q[order]], kind="stable")]
            p, q = i + p[order], j + q[order]
            root = {c: c for c in comps[np.append(p, q)].tolist()}
            left, out = len(root), []
            for m, n, c, d in zip(p.tolist(), q.tolist(), comps[p].tolist(), comps[q].tolist()):
                while root[c] != c:
                    c = root[c]
                while root[d] != d:
                    d = root[d]
                if c != d:
                    root[max(c, d)] = min(c, d)
                    out.append((min(ids[m], ids[n]), max(ids[m], ids[n])))
                    left -= 1
                    if left == 1:
                        break
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Proposals of all groups, whose rows come together."""
    rest = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
        columns.append(batch.column(5).flatten().to_numpy(zero_copy_only=False).reshape(-1, COORDINATES))
        if rest is not None:
            columns = [np.concatenate(pair) for pair in zip(rest, columns)]
        group, crossing, ids, comps, blocks, sigs = columns
        if not len(group):
            continue
        cut = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        for b, e in zip(cut[:-1], cut[1:]):
            yield from _proposals(ids[b:e], comps[b:e], sigs[b:e], blocks[b:e], bool(crossing[b]))
        rest = [c[cut[-1] :] for c in columns]
    if rest is not None:
        yield from _proposals(*(rest[k] for k in (2, 3, 5, 4)), bool(rest[1][0]))


def _exhaustive(nodes: DataFrame, reps: DataFrame) -> DataFrame:
    """Likely pairs a, b that join the nodes' components.

    A node is cut into blocks of about SIDE members, and every two blocks are a group.
    """
    n = F.ceil(F.col("size") / SIDE).cast("int")
    block = F.pmod(F.xxhash64("rep", F.lit(3)), n).cast("int")
    rows = nodes.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    group = F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other"))
    rows = rows.select(group.alias("group"), (F.col("block") != F.col("other")).alias("crossing"), "rep", "component", "block")
    rows = rows.join(reps, "rep").select("group", "crossing", "rep", "component", "block", "sig")
    return rows.repartition("group").sortWithinPartitions("group").mapInArrow(_compare, "a bigint, b bigint")


def _multi(nodes: DataFrame) -> DataFrame:
    """Rows of nodes with two members or more, with the node's size and pivot."""
    sizes = nodes.groupBy("node").agg(F.count("*").alias("size"), F.min(F.struct(F.xxhash64("rep").alias("order"), "rep")).alias("pivot")).where("size > 1")
    return nodes.join(sizes.select("node", "size", F.col("pivot.rep").alias("pivot")), "node")


def _star(nodes: DataFrame) -> DataFrame:
    return nodes.where("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"))


def _roots(reps: DataFrame) -> DataFrame:
    """The first branch: a node of every tree for each vertex."""
    tree = F.explode(F.array(*[F.xxhash64(F.lit(r), F.col("sig")[2 * r], F.col("sig")[2 * r + 1]) for r in range(TREES)]))
    return reps.select(tree.alias("node"), "rep")


def _branches(nodes: DataFrame, reps: DataFrame) -> DataFrame:
    """Children of nodes: each path selects coordinates, 1 / threshold expected, one at least."""
    share = round(2**20 / (THRESHOLD / 100 * COORDINATES))
    chosen = F.filter(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda j: F.pmod(F.xxhash64("node", j), F.lit(2**20)) < share)
    chosen = F.when(F.size(chosen) > 0, chosen).otherwise(F.array(F.pmod(F.xxhash64("node", F.lit(-1)), F.lit(COORDINATES)).cast("int")))
    rows = nodes.select("node", "rep").join(reps, "rep").select("rep", "node", "sig", F.explode(chosen).alias("j"))
    return rows.select(F.xxhash64("node", "j", F.expr("sig[j]")).alias("node"), "rep")


def _shares(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """How many values two sorted sets share, and how many they have together."""
    both = np.sort(np.concatenate([x, y]))
    common = int((both[1:] == both[:-1]).sum())
    return common, len(both) - common


def _parts(sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Ranges of sets with at most PART values, or one set."""
    ends, at = np.cumsum([len(x) for x in sets]), 0
    while at < len(sets):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART, "right")))
        yield at, to
        at = to


def _spread(sets: list[np.ndarray], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the values in ``known`` their place there and their set, by place."""
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    place = np.searchsorted(known, values)
    kept = np.flatnonzero(known[np.minimum(place, len(known) - 1)] == values)
    kept = kept[np.argsort(place[kept], kind="stable")]
    return place[kept], owner[kept]


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each set of one side shares with each of the other, exactly."""
    out = np.zeros((len(left), len(right)), np.int64)
    for i, m in _parts(left):
        values = np.unique(np.concatenate(left[i:m]))
        for j, n in _parts(right):
            known = np.intersect1d(values, np.unique(np.concatenate(right[j:n])), assume_unique=True)
            if not len(known):
                continue
            x, y = _spread(left[i:m], known), _spread(right[j:n], known)
            for at in range(0, len(known), WIDTH):
                sides = []
                for (place, owner), size in ((x, m - i), (y, n - j)):
                    b, e = np.searchsorted(place, (at, at + WIDTH))
                    side = np.zeros((size, min(WIDTH, len(known) - at)), np.float32)
                    side[owner[b:e], place[b:e] - at] = 1
                    sides.append(side)
                out[i:m, j:n] += (sides[0] @ sides[1].T).astype(np.int64)
    return out


def _tile(rows: pa.Table) -> pa.Table:
    """Links between the components of a tile: likeliest pairs first, one link for two components.

    All pairs are counted on their full sets.
    """
    left = rows.column("left").to_numpy()
    ids, comps = rows.column("rep").to_numpy(), rows.column("component").to_numpy()
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("members")]
    p, q = np.flatnonzero(left), np.flatnonzero(~left)
    common, sizes = _common([sets[k] for k in p], [sets[k] for k in q]), np.array([len(x) for x in sets], np.int64)
    union = sizes[p, None] + sizes[None, q] - common
    i, j = np.nonzero((common > 0) & (100 * common >= THRESHOLD * union) & (comps[p, None] != comps[None, q]))
    order = np.argsort(-common[i, j] / union[i, j], kind="stable")
    root = {c: c for c in comps.tolist()}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for x, y in zip(p[i[order]].tolist(), q[j[order]].tolist()):
        c, d = find(int(comps[x])), find(int(comps[y]))
        if c != d:
            root[max(c, d)] = min(c, d)
            out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def _within_clusters(near: DataFrame, found: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Links between different components of one cluster, saved; None if no cluster has several."""
    edges = found.select(F.col("rep").alias("a"), F.col("component").alias("b"))
    clusters = components(near.unionByName(edges)).withColumnRenamed("component", "cluster")
    clusters = clusters.unionByName(clusters.select(F.col("cluster").alias("rep"), "cluster").distinct())
    members = clusters.join(found, "rep", "left").select("cluster", "rep", F.coalesce("component", "rep").alias("component"))
    members = saved(members.join(sets.select("rep", F.octet_length("members").alias("bytes")), "rep"), "clusters")
    size = [F.count("*").alias("members"), (F.sum("bytes") / 8).alias("values")]
    sizes = members.groupBy("cluster", "component").agg(*size).groupBy("cluster")
    sizes = sizes.agg(F.sum("members").alias("members"), F.sum("values").alias("values"), F.max(F.struct("members", "values", "component")).alias("main")).where("members > main.members")
    blocks = lambda members, values: F.ceil(F.greatest(members / TILE, values / TILE_VALUES)).cast("int")
    sizes = sizes.select("cluster", F.col("main.component").alias("main"), blocks(F.col("members") - F.col("main.members"), F.col("values") - F.col("main.values")).alias("lefts"), blocks(F.col("members"), F.col("values")).alias("rights"))
    mixed = saved(members.join(sizes, "cluster"), "open")
    if not mixed.limit(1).count():
        return None
    # Members outside a cluster's main component meet all members: left blocks by right blocks.
    place = lambda n, seed: F.pmod(F.xxhash64("rep", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = mixed.where("component <> main").withColumns({"i": place("lefts", 5), "left": F.lit(True)}).withColumn("j", every("rights"))
    right = mixed.withColumns({"j": place("rights", 6), "left": F.lit(False)}).withColumn("i", every("lefts"))
    both = left.unionByName(right).select("cluster", "i", "j", "left", "rep", "component")
    return saved(both.join(sets, "rep").groupBy("cluster", "i", "j").applyInArrow(_tile, "a bigint, b bigint").distinct(), "links")


def _decided(pairs: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, link, near of candidate pairs; those that sizes or tokens rule out are no longer there."""
    a, b = (reps.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}")) for x in "ab")
    fits = 100 * F.least("n_a", "n_b") >= THRESHOLD * F.greatest("n_a", "n_b")
    equal = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    likely = saved(pairs.distinct().join(a, "a").join(b, "b").where(fits & (equal >= CANDIDATE)).select("a", "b"), "likely")

    def side(name: str) -> DataFrame:
        """The sets that this side of the pairs needs."""
        wanted = likely.select(F.col(name).alias("wanted")).distinct()
        own = sets
        if wanted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
            own = sets.join(F.broadcast(wanted), F.col("rep") == F.col("wanted"), "left_semi")
        return own.select(F.col("rep").alias(name), F.col("members").alias(f"members_{name}"))

    both = likely.join(side("a"), "a").join(side("b"), "b").select("a", "b", "members_a", "members_b")
    return saved(both.mapInArrow(_decide, "a bigint, b bigint, link boolean, near boolean"), "decided")


def components(edges: DataFrame) -> DataFrame:
    """Per vertex with an edge its component's smallest vertex, by large and small stars."""

    def stars(pairs: DataFrame, small: bool) -> DataFrame:
        if small:
            # each vertex with its smaller neighbours
            near = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        else:
            near = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = near.join(least, "u")
        if small:
            out = joined.select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
        else:
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return out.where("a <> b").distinct()

    while True:
        edges = saved(stars(stars(edges, False), True), "stars")
        # Done when every vertex has one edge and no vertex is the end of another's: all stars.
        n, n_left = edges.agg(F.count("*"), F.count_distinct("a")).first()
        ends = edges.select(F.col("b").alias("a")).distinct()
        if n == n_left and not edges.join(ends, "a", "left_semi").limit(1).count():
            return edges.select(F.col("a").alias("rep"), F.col("b").alias("component"))


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """id, h (a hash of the text as it is), text."""
    return docs.select(F.col(id_column).cast("bigint").alias("id"), F.xxhash64(text_column).alias("h"), F.col(text_column).alias("text"))


def _sets_of(rows: DataFrame, owners: DataFrame, repeated: bool) -> DataFrame:
    """rep, members: the sets of some vertices, each from the row that owns it; saved."""
    owners = owners.select("rep", F.col("own.id").alias("own_id"), F.col("own.h").alias("own_h"))
    if owners.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        owners = F.broadcast(owners)
    sets = rows.join(owners, (F.col("id") == F.col("own_id")) & (F.col("h") == F.col("own_h"))).select("rep", "text").mapInArrow(_sets, "rep bigint, members binary")
    return saved(sets.dropDuplicates(["rep"]) if repeated else sets, "sets")


def _components_of_rows(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, bool]:
    """id, h, n, label (of the component; null without words), first (its smallest id) of every
    row, and whether any row repeats."""
    bounded_batches(docs.sparkSession)
    rows = _rows(docs, id_column, text_column)
    features = saved(rows.mapInArrow(_features, "id bigint, h bigint, n bigint, k1 bigint, k2 bigint, sig array<int>"), "features")
    repeated = features.where("id is not null").groupBy("id", "h").count().where("count > 1").limit(1).count() > 0
    full = features.where("n > 0 and id is not null")
    owned = full.groupBy("k1", "k2", "n").agg(F.min(F.struct("id", "h")).alias("own"), F.first("sig").alias("sig"))
    # The running number is a vertex's name from here on: the table is written once and then only read.
    owned = saved(owned.withColumn("rep", F.monotonically_increasing_id()), "vertices")
    reps = owned.select("rep", "n", "sig")

    def mixed(rows: DataFrame, found: DataFrame) -> DataFrame:
        """The nodes whose members are in several components, with these."""
        placed = rows.select("node", "rep", "size").join(found, "rep", "left").select("node", "rep", "size", F.coalesce("component", "rep").alias("component"))
        several = placed.groupBy("node").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("node")
        return saved(placed.join(several, "node", "left_semi"), "mixed")

    def merged(found: DataFrame, links: DataFrame) -> DataFrame:
        return components(found.select(F.col("rep").alias("a"), F.col("component").alias("b")).unionByName(links))

    nodes = saved(_multi(_roots(reps)), "nodes")
    # Whatever is compared from here on shares a node with another vertex.
    sets = _sets_of(rows, owned.join(nodes.select("rep").distinct(), "rep", "left_semi"), repeated)
    decided = _decided(_star(nodes), reps, sets)
    found = components(decided.where("link").select("a", "b"))
    for depth in range(1, DEPTH + 1):
        active = mixed(nodes, found)
        small = F.col("size") <= LEAF if depth < DEPTH else F.lit(True)
        n_large = active.where(~small).count()
        pairs = _exhaustive(active.where(small), reps)
        if n_large:
            nodes = saved(_multi(_branches(active.where(~small), reps)), "nodes")
            pairs = pairs.unionByName(_star(nodes))
        more = _decided(pairs.join(decided, ["a", "b"], "left_anti"), reps, sets)
        decided = decided.unionByName(more)
        found = merged(found, more.where("link").select("a", "b"))
        if not n_large:
            break
    links = _within_clusters(decided.where("near").select("a", "b"), found, sets)
    if links is not None:
        found = merged(found, links)

    # Each component's smallest id; vertices without a link are their own component.
    linked = found.unionByName(found.select(F.col("component").alias("rep"), "component").distinct())
    ids = linked.join(owned.select("rep", F.col("own.id").alias("id")), "rep")
    firsts = linked.join(ids.groupBy("component").agg(F.min("id").alias("first")), "component")
    vertex = owned.join(firsts, "rep", "left").select("k1", "k2", "n", F.coalesce("component", "rep").alias("label"), F.coalesce("first", "own.id").alias("first"))
    out = full.select("id", "h", "n", "k1", "k2").join(vertex, ["k1", "k2", "n"]).select("id", "h", "n", "label", "first")
    others = features.where("n = 0 or id is null").select("id", "h", "n", F.lit(None).cast("bigint").alias("label"), F.col("id").alias("first"))
    return out.unionByName(others), repeated


def groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, n_shingles, component_id (smallest linked id, itself included), kept."""
    rows, _ = _components_of_rows(docs, id_column, text_column)
    return rows.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.col("first").alias("component_id"), F.coalesce(F.col("first") == F.col("id"), F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Of rows of one group that share that id one stays, and so of rows without words that
    share an id; rows with a null id all stay.
    """
    rows, repeated = _components_of_rows(docs, id_column, text_column)
    kept_id, kept_h = free_name(docs, "kept_id"), free_name(docs, "kept_h")
    keep = saved(rows.where("id = first").groupBy("id", "label").agg(F.min("h").alias(kept_h)).select(F.col("id").alias(kept_id), kept_h), "kept")
    if keep.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        keep = F.broadcast(keep)
    known = docs.where(F.col(id_column).isNotNull())
    out = known.join(keep, (F.col(id_column).cast("bigint") == F.col(kept_id)) & (F.xxhash64(text_column) == F.col(kept_h)), "left_semi")
    if repeated:
        name = free_name(docs, "text_hash")
        out = out.withColumn(name, F.xxhash64(text_column)).dropDuplicates([id_column, name]).drop(name)
    return out.unionByName(docs.where(F.col(id_column).isNull()))
