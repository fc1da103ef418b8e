"""Quality scores by Bradley-Terry pairwise ranking (op 8).

Every text becomes a vector. Its shape: rates of character classes and of each ASCII mark, word
and line statistics, repetition. Its content: how often its words, pairs of neighbouring words
and runs of three bytes fall into each of some hash buckets. Labelled documents form
preference pairs (one of label 1 over one of label 0); a logistic loss on the differences of
their features gives the weights (those of content are held smaller), so a document's score is
its log-odds of being preferred. The cut is a quantile of the labelled scores: the quantile that
best separates the labels. Scores map to (0, 1) by a logistic curve whose value at the cut is CUT.

Training rows are a bounded sample (MAX_LABELLED ids at most, chosen by a hash of the id, one
row each); scoring covers every text whole. Null text is empty; an empty text has a score like any
other. Labels that are null or contradict each other for a doc_id are not used; without
labels of both kinds all documents score 0.5. Repeated rows and rows with a null id are
scored each, and equal texts have equal scores. A very long text is scored whole, by itself. An
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, free_name, not_held_out, text_slices
from .words import SPACED, mix, split_words

#: Text bytes that are looked at at a time (a longer text is looked at alone).
SLICE = 1 << 20
#: Bound on the labelled rows that are learned from.
MAX_LABELLED = 20_000
#: Hash buckets for words, as many for pairs of words, and for runs of three bytes.
BUCKETS = 16
#: How strongly weights are drawn to zero: those of shape, and those of content.
SHAPE_PENALTY, CONTENT_PENALTY = 1e-4, 1e-1
#: Preference pairs drawn for each step of the fit.
PAIRS = 10_000
STEPS = 250
#: Share of rejected documents that the choice of the cut may give up to keep good ones.
SLACK = 0.005
#: A document at the cut scores so much, and is accepted from there on.
CUT = 0.7
MARKS = np.array([k for k in range(33, 127) if not chr(k).isalnum()])


def _runs(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: how many of its values are distinct, and how often the commonest occurs."""
    n = len(at) - 1
    owner = np.repeat(np.arange(n), np.diff(at))
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    head = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (o[1:] != o[:-1]))) if len(v) else np.zeros(0, np.int64)
    size = np.diff(np.append(head, len(v)))
    distinct = np.bincount(o[head], minlength=n) if len(v) else np.zeros(n, np.int64)
    most = np.zeros(n, np.int64)
    if len(v):
        np.maximum.at(most, o[head], size)
    return distinct, most


def _word_pairs(words: np.ndarray, word_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each pair of neighbouring words, and where each text's pairs begin."""
    pairs = words[:-1] * np.uint64(3) + words[1:] if len(words) > 1 else words[:0]
    # a pair that begins with a text's last word belongs to no text; dropping it keeps bounds simple
    inner = np.ones(len(words), bool)
    inner[word_at[1:][np.diff(word_at) > 0] - 1] = False
    return pairs[inner[: len(pairs)]], np.append(0, np.cumsum(inner, dtype=np.int64))[word_at]


def content(data: np.ndarray, bounds: np.ndarray, words: np.ndarray, word_at: np.ndarray, buckets: int) -> np.ndarray:
    """For each text the root of the share of its words, word pairs and byte runs in each bucket."""
    n = len(bounds) - 1
    byte = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint64)
    runs = (byte[:-2] << np.uint64(16)) | (byte[1:-1] << np.uint64(8)) | byte[2:] if len(byte) > 2 else byte[:0]
    inner = np.ones(len(byte), bool)
    for back in (1, 2):  # a run does not cross the end of its text
        inner[np.maximum(bounds[1:] - back, bounds[:-1])[np.diff(bounds) > 0]] = False
    run_at = np.append(0, np.cumsum(inner, dtype=np.int64))[bounds]
    parts = []
    for values, at in ((words, word_at), _word_pairs(words, word_at), (runs[inner[: len(runs)]], run_at)):
        size = np.diff(at)
        bucket = (mix(values) % np.uint64(buckets)).astype(np.int64)
        counts = np.bincount(np.repeat(np.arange(n) * buckets, size) + bucket, minlength=n * buckets).reshape(n, buckets)
        parts.append(np.sqrt(counts / np.maximum(size, 1)[:, None]).astype(np.float32))
    return np.hstack(parts)


def described(data: np.ndarray, bounds: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Shape and content of each text."""
    split = split_words(data, bounds, SPACED)
    return np.hstack([features(data, bounds, split).astype(np.float32), content(data, bounds, *split, buckets)])


def features(data: np.ndarray, bounds: np.ndarray, split: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """A row of shape features for each text."""
    n = len(bounds) - 1
    length = np.diff(bounds)
    safe = np.maximum(length, 1)

    def rate(mask: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(mask, dtype=np.int64))
        return (total[bounds[1:]] - total[bounds[:-1]]) / safe

    owner = np.repeat(np.arange(n), length)
    counts = np.bincount(owner * 128 + np.minimum(data, 127), minlength=n * 128).reshape(n, 128)
    marks = counts[:, MARKS] / safe[:, None]
    upper, digits = counts[:, 65:91].sum(1) / safe, counts[:, 48:58].sum(1) / safe
    lower, space = counts[:, 97:123].sum(1) / safe, counts[:, [9, 10, 13, 32]].sum(1) / safe
    words, word_at = split_words(data, bounds, SPACED) if split is None else split
    n_words = np.diff(word_at)
    some = np.maximum(n_words, 1)
    distinct, most = _runs(words, word_at)
    pairs, pair_at = _word_pairs(words, word_at)
    pair_distinct, pair_most = _runs(pairs, pair_at)
    n_pairs = np.maximum(np.diff(pair_at), 1)
    lines = counts[:, 10] + 1
    return np.column_stack(
        [
            np.sqrt(marks),
            np.sqrt(upper),
            np.sqrt(digits),
            lower,
            space,
            rate(data >= 128),
            np.log1p(n_words),
            np.log1p(length / some),
            distinct / some,
            most / some,
            pair_distinct / n_pairs,
            pair_most / n_pairs,
            np.log1p(some / lines),
            (n_words == 0).astype(float),
            (n_words < 5).astype(float),
        ]
    )


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7, penalty: float | np.ndarray = SHAPE_PENALTY) -> dict:
    """Weights of the pairwise logistic loss, and the cut; ``penalty`` may differ by feature."""
    if not (y == 1).any() or not (y == 0).any():
        return {"mean": np.zeros(x.shape[1]), "scale": np.ones(x.shape[1]), "weights": np.zeros(x.shape[1]), "cut": 0.0, "slope": 0.0, "base": 0.0}
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    good, bad = z[y == 1], z[y == 0]
    rng = np.random.default_rng(seed)
    w, momentum, square = np.zeros(z.shape[1]), np.zeros(z.shape[1]), np.zeros(z.shape[1])
    for step in range(1, STEPS + 1):
        g, b = rng.integers(len(good), size=PAIRS), rng.integers(len(bad), size=PAIRS)
        wrong = 1 / (1 + np.exp(np.clip((good @ w)[g] - (bad @ w)[b], -50, 50)))
        # the mean over the pairs, with the rows' shares in it summed first
        pull, push = (np.bincount(k, wrong, len(rows)) / PAIRS for k, rows in ((g, good), (b, bad)))
        gradient = push @ bad - pull @ good + penalty * w
        momentum = 0.9 * momentum + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        w -= 0.1 * (momentum / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    s = z @ w
    # The quantile of the scores below which to reject: best mean accuracy over both labels,
    # and among quantiles within SLACK of the best the lowest, which keeps more documents.
    order = np.argsort(s, kind="stable")
    below_bad, below_good = np.cumsum(y[order] == 0) / (y == 0).sum(), np.cumsum(y[order] == 1) / (y == 1).sum()
    gain = below_bad - below_good
    best = int(np.argmax(gain >= gain.max() - SLACK))
    level = (best + 1) / len(s)
    cut = float((s[order[best]] + s[order[min(best + 1, len(s) - 1)]]) / 2)
    return {"mean": mean, "scale": scale, "weights": w, "cut": cut, "slope": 1.0, "level": level, "base": float(np.log(CUT / (1 - CUT)))}


def scores(model: dict, x: np.ndarray) -> np.ndarray:
    z = np.clip((x - model["mean"]) / model["scale"], -8, 8)
    return 1 / (1 + np.exp(-np.clip(model["slope"] * (z @ model["weights"] - model["cut"]) + model["base"], -30, 30)))


def _vectors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in text_slices(batch, "text", SLICE):
                x = described(data, bounds, buckets)
                at = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
                yield pa.RecordBatch.from_arrays([part.column("label_id"), part.column("y"), pa.ListArray.from_arrays(at, x.reshape(-1))], ["label_id", "y", "x"])

    return run


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", learnable: Column | None = None, max_labelled: int = MAX_LABELLED, buckets: int = BUCKETS) -> dict:
    """Fit on the labelled documents that may be learned from (all folds but one, if not given)."""
    usable = labels.select(F.col(id_column).alias("label_id"), F.col(label_column).cast("int").alias("y")).where(F.col("label_id").isNotNull() & F.col("y").isin(0, 1))
    usable = usable.where(not_held_out(F.col("label_id")) if learnable is None else learnable)
    agreed = usable.groupBy("label_id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2").select("label_id", "y")
    total = max(1, agreed.count())
    share = min(1.0, 0.9 * max_labelled / total)
    sample = agreed.where(F.pmod(F.xxhash64("label_id", F.lit(8)), F.lit(1 << 30)) < int(share * (1 << 30))).limit(max_labelled)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(F.broadcast(sample), F.col("id") == F.col("label_id"))
    # Of rows that repeat an id one is learned from, so what reaches the driver is bounded.
    rows = rows.groupBy("label_id").agg(F.first("y").alias("y"), F.min_by("text", F.xxhash64("text")).alias("text"))
    kind = rows.schema["label_id"].dataType.simpleString()
    found = rows.select("label_id", "y", "text").mapInArrow(_vectors(buckets), f"label_id {kind}, y int, x array<float>").toArrow()
    found = found.sort_by("label_id").combine_chunks()  # the fit does not depend on the order of arrival
    width = described(np.zeros(0, np.uint8), np.zeros(2, np.int64), buckets).shape[1]
    y = found.column("y").to_numpy()
    x = pa.chunked_array(found.column("x").chunks, pa.list_(pa.float32())).combine_chunks().flatten().to_numpy().reshape(len(y), width)
    penalty = np.full(width, SHAPE_PENALTY)
    penalty[-3 * buckets :] = CONTENT_PENALTY
    return fit(x, y, penalty=penalty) | {"buckets": buckets}


def score(docs: DataFrame, model: dict, text_column: str = "text") -> tuple[DataFrame, str]:
    """All columns of ``docs`` and the score; the new column's name is returned too."""
    bounded_batches(docs.sparkSession)
    name = free_name(docs, "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in text_slices(batch, text_column, SLICE):
                found = scores(shared.value, described(data, bounds, shared.value["buckets"])).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], [*part.schema.names, name])

    schema = docs.sparkSession.createDataFrame([], docs.schema).selectExpr("*", f"cast(null as double) as `{name}`").schema
    return docs.mapInArrow(run, schema), name


def accepted(docs: DataFrame, model: dict, text_column: str = "text") -> DataFrame:
    """The documents that reach the cut."""
    scored, name = score(docs, model, text_column)
    return scored.where(F.col(name) >= CUT).drop(name)
