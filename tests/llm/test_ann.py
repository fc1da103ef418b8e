"""Neighbours: recall against brute force, exact scores, ties, odd vectors."""

import numpy as np
from pyspark.sql import functions as F

from roadspark.llm import ann
from roadspark.llm.common import table


def brute(x, ids, queries, k):
    out = {}
    for q, v in zip(ids, x):
        if queries(q):
            score = (x * v).sum(1)
            order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
            out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall(spark):
    for sf in ("sf0.001", "sf0.1"):
        df = table(spark, f"/root/testdata/{sf}", "embeddings")
        p = df.toPandas()
        x, ids = np.array(p.embedding.tolist(), float), p.vec_id.to_numpy()
        true, got = brute(x, ids, lambda q: q % 20 == 0, 20), found(ann.search(df, F.col("id") % 20 == 0))
        hits = sum(len({v for v, _ in true[q]} & {v for v, _ in got[q]}) for q in true)
        assert hits / (20 * len(true)) >= 0.9
        exact = {q: dict(zip(ids, (x * x[list(ids).index(q)]).sum(1))) for q in list(got)[:5]}
        assert all(abs(s - exact[q][v]) < 1e-12 for q in exact for v, s in got[q])


def test_unequal_norms_and_ties(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 8)) * rng.uniform(0.1, 5, size=(1500, 1))
    x[100:700] = x[100]  # a hot group of equal vectors
    df = spark.createDataFrame([(int(k), v.tolist(), "x") for k, v in enumerate(x)], "vec_id long, embedding array<double>, rank string")
    true, got = brute(x, np.arange(1500), lambda q: q % 20 == 0, 10), found(ann.search(df, F.col("id") % 20 == 0, k=10))
    assert sum(len(set(true[q]) & set(got[q])) for q in true) / (10 * len(true)) >= 0.9
    assert [v for v, _ in got[120]] == [v for v, _ in true[120]] or got[120][0][1] >= true[120][0][1]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (40, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(ann.search(df, F.col("id") % 20 == 0)) == {0: [(1, 0.5), (20, 0.5)], 20: [(0, 0.5), (1, 0.5)]}
    assert ann.search(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_repeated_rows(spark):
    """Every row but the query's own is a candidate; a query id has a list for each different vector."""
    rng = np.random.default_rng(5)
    rows = [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [0.9, 0.1]), (2, [0.2, 0.8]), (3, [0.5, 0.4]), (3, [0.5, 0.4])]
    some = rng.integers(0, 3, (40, 2)).astype(float)
    for rows in (rows, [(int(i), v.tolist()) for i, v in zip(rng.choice([20, 40, 5, 6], 40), some) if v.any()]):
        expected = []
        for q, v in {(i, tuple(x)) for i, x in rows if i % 20 == 0}:
            rest = [(i, tuple(x)) for i, x in rows]
            rest.remove((q, v))
            near = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in rest)[:6]
            expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(near, 1)]
        df = spark.createDataFrame(rows * 1, "vec_id long, embedding array<double>")
        got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(df, F.col("id") % 20 == 0, k=6).collect())
        assert got == sorted(expected)


def test_dimensions_search_among_themselves(spark):
    rows = [(20, [1.0, 0.0]), (1, [0.5, 0.0]), (40, [1.0]), (41, [3.0]), (42, [2.0]), (43, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(ann.search(df, F.col("id") % 20 == 0)) == {20: [(1, 0.5)], 40: [(41, 3.0), (42, 2.0)]}


def test_small_cells(spark, monkeypatch):
    """Blocks and chunks of a few rows give what whole shelves give."""
    df = table(spark, "/root/testdata/sf0.001", "embeddings")
    whole = found(ann.search(df, F.col("id") % 20 == 0))
    for name, value in (("CELL_VECTORS", 9), ("CELL_QUERIES", 3), ("SHELF", 3)):
        monkeypatch.setattr(ann, name, value)
    assert found(ann.search(df, F.col("id") % 20 == 0)) == whole
