"""Near duplicates against brute force, on groups of many kinds."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from roadspark.llm import neardup, words


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def plain(rows):
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(d, shingles(t)) for d, t in rows]
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted((d, len(s), find(d), d == find(d)) for d, s in sets)


def same(x, y):
    common, union = neardup._shares(x, y)
    return common > 0 and 100 * common >= 75 * union


def case(seed, words=60, groups=25):
    rnd = random.Random(seed)
    text = lambda n: [f"w{rnd.randint(0, 400)}" for _ in range(n)]
    shared, rows = text(30), []
    for g in range(groups):
        base = text(rnd.choice([1, 4, 5, 8, words, words * 3]))
        if g % 3 == 0:
            base += shared
        for _ in range(rnd.choice([1, 1, 2, 5, 12])):
            own = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                own[rnd.randrange(len(own))] = f"e{rnd.randint(0, 10**6)}"
            rows.append(" ".join(own).upper() if rnd.random() < 0.2 else "\t".join(own))
    rows += ["", "", " \n"]
    rnd.shuffle(rows)
    return [(3 * k + 1, t) for k, t in enumerate(rows)] + [(10_000, None)]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string")
    return sorted(tuple(r) for r in neardup.groups(df).collect())


def test_against_brute_force(spark):
    rows = case(1)
    assert run(spark, rows) == plain(rows)


def test_small_nodes_branch_and_tile(spark, monkeypatch):
    """One dense group near the threshold, with nodes so small that all ways are taken."""
    for name, value in (("LEAF", 8), ("SIDE", 5), ("BLOCK", 4), ("TILE_VALUES", 500)):
        monkeypatch.setattr(neardup, name, value)
    rnd = random.Random(4)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for k in range(70):
        own = list(base)
        for _ in range(rnd.randint(1, 3)):
            own[rnd.randrange(80)] = f"e{rnd.randint(0, 10**6)}"
        rows.append((k, " ".join(own)))
    assert run(spark, rows) == plain(rows)


def test_tiles_compare_full_sets(monkeypatch):
    """Links count in a tile even where no token of the sketches is equal."""
    rng = np.random.default_rng(3)
    for part, width in ((1 << 20, 4096), (300, 7)):
        monkeypatch.setattr(neardup, "PART", part, raising=False)
        monkeypatch.setattr(neardup, "WIDTH", width, raising=False)
        base = np.arange(100, dtype=np.uint64) * np.uint64(2**57 + 1)
        sets = [np.sort(np.append(rng.choice(base, n, replace=False), rng.integers(1, 2**63, m).astype(np.uint64))) for n, m in zip(rng.integers(70, 101, 40), rng.integers(0, 30, 40))]
        sets += [base[:0], base[:1], base]
        n = len(sets)
        sigs = np.arange(n * neardup.COORDINATES, dtype=np.int32).reshape(n, -1)
        left = [k % 2 == 0 for k in range(n)]
        table = pa.table({"left": left, "rep": list(range(n)), "component": list(range(n)), "members": pa.array([x.tobytes() for x in sets], pa.binary()), "sig": sigs.tolist()})
        root = list(range(n))
        for x in range(n):
            for y in range(n):
                if left[x] and not left[y] and same(sets[x], sets[y]):
                    root = [root[x] if r == root[y] else r for r in root]
        mine = list(range(n))
        for a, b in zip(*(c.to_pylist() for c in neardup._tile(table).columns)):
            assert same(sets[a], sets[b]) and mine[a] != mine[b]
            mine = [mine[a] if r == mine[b] else r for r in mine]
        assert len(set(root)) < n
        assert [root.index(r) for r in root] == [mine.index(r) for r in mine]


def test_a_node_above_leaf(spark):
    """A group beyond LEAF of which many pairs lie just around the threshold: every link counts."""
    rnd, base = random.Random(8), [f"w{k}" for k in range(64)]
    rows = []
    for k in range(neardup.LEAF + 400):
        own = list(base)
        # texts that differ in one of these words are links (55 of 65 shingles), in two not (50 of 70)
        for at in (10, 30, 50):
            own[at] = f"e{rnd.randint(0, 59)}"
        rows.append((k, " ".join(own)))
    number = {}
    member = np.zeros((len(rows), 64 + 3 * 60 * 5), np.float32)
    for k, t in rows:
        for g in shingles(t):
            member[k, number.setdefault(g, len(number))] = 1
    assert len(number) <= member.shape[1]
    common, n = member @ member.T, member.sum(1)
    linked = 100 * common >= 75 * (n[:, None] + n[None] - common)
    label = np.arange(len(rows))
    while True:
        after = np.where(linked, label[None], len(rows)).min(1)
        if (after == label).all():
            break
        label = after
    got = {r.doc_id: r.component_id for r in neardup.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k] for k in range(len(rows))] == label.tolist() and len(set(label.tolist())) > 100


def test_ids_that_repeat_a_hundred_times(spark):
    text = " ".join(f"v{k}" for k in range(60))
    rows = [(1, text)] * 100 + [(2, text + " end")] * 100 + [(3, "other words than these are here"), (3, text + " fin"), (4, text)]
    got = sorted(tuple(r) for r in neardup.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([(1, 56, 1, True)] * 100 + [(2, 57, 1, False)] * 100 + [(3, 2, 3, True), (3, 57, 1, False), (4, 56, 1, False)])
    kept = neardup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in kept) == [(1, text), (3, "other words than these are here")]


def test_words_that_defeat_polynomial_hashes():
    thue = ["a" if bin(k).count("1") % 2 else "b" for k in range(4096)]
    one, two = "".join(thue), "".join("b" if c == "a" else "a" for c in thue)
    data = f"{one} {two}".encode()
    found, at = words.split_words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert len(set(found.tolist())) == 2 and at.tolist() == [0, 2]


def test_long_texts_split_in_pieces(monkeypatch):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("ab  \n") for _ in range(rnd.choice([0, 3, 50, 400]))).encode() for _ in range(30)] + [b"x" * 200]
    bounds = np.append(0, np.cumsum([len(t) for t in texts]))
    data = np.frombuffer(b"".join(texts), np.uint8)
    whole = words.split_words(data, bounds, words.SPACED)
    for piece in (7, 64):
        monkeypatch.setattr(words, "PIECE", piece)
        cut = words.split_words(data, bounds, words.SPACED)
        assert cut[0].tolist() == whole[0].tolist() and cut[1].tolist() == whole[1].tolist()


def test_deduplicate(spark):
    long = " ".join(f"v{k}" for k in range(30_000))
    rows = [(4, "a b c d e f", 1), (2, "a b c d e f", 2), (2, "a b c d e f", 2), (None, "a b c d e f", 3), (5, None, 4), (6, "", 5), (7, long, 6), (8, long + " end", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_id int")
    got = neardup.deduplicate(df)
    assert got.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(map(str, [2, None, 5, 6, 7]))
    assert neardup.deduplicate(df.limit(0)).count() == 0


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (3, 4), (4, 5), (9, 8)], [(k, k + 1) for k in range(40)], []])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    parent = {}
    for a, b in edges:
        for v in (a, b):
            parent.setdefault(v, v)
    for _ in edges:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = {r.rep: r.component for r in neardup.components(df).collect()}
    assert got == {v: c for v, c in parent.items() if v != c}
