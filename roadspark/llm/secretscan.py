"""Secret scans by rules and a character convolutional network (op 13).

Three rules find base spans: assignments of a value to a secret's name, access keys and long hex
runs; each leftmost without overlaps, and what is too short is dropped afterwards.

Candidates are runs of the characters that keys are made of: of LONG characters or more, or of
SHORT or more with both a digit and a letter. The network sees every candidate whole, however
long, with BEFORE characters before and AFTER behind it. A convolution over characters (a weight
for each character at each of WIDTH places, FILTERS filters) is pooled over the candidate (largest
and mean) and over either side (largest); a hidden layer and a logistic unit follow. It is
written in numpy, with its own backward pass.

It learns from labelled findings: candidates with a 1 if a rule covers them and a 0 if not, of
documents that may be learned from; :func:`fit` takes findings with labels from elsewhere as
well. Different findings count once each, and all of them are used, whatever their length. They are
dealt by hash to shards of about SHARD findings, which learn side by side: in each of ROUNDS rounds
a shard goes through all its findings with Adam, from the weights of the round before, and the
weights (and Adam's means) of all shards are averaged, as sums of whole numbers, so that no order of
tasks matters. Findings of a label so rare that a shard would have fewer than RARE are copied to
several shards. While it learns, bodies of positive findings are at times drawn anew from other
alphabets, the text before is at times hidden and the case changed, so that neither one alphabet nor
one name is all it knows. Both labels have half of each batch. A quarter of the findings, by hash, is
not trained on: all of it calibrates the scores (Platt scaling, moved to the corpus's own share of
positives), and for each shape of candidate (hex, upper case, mixed) the threshold is the
highest that keeps RECALL of its positive findings, less half the way (in log odds) to the next
lower score of any finding; shapes with few findings share one. Logits count in steps of 1 / GRID, so
that findings of equal logit are counted by Spark and only the counts come to the driver.
Candidates at or above their threshold that touch no base span are added with the kind ``net``.
Without findings of both labels nothing is added.

Places are code points, ends exclusive. Null texts are empty and have no spans. Documents are
judged row by row, whatever their ids; other columns play no part in a scan and stay in
:func:`scan`'s rows. Equal windows have equal scores. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, free_name, not_held_out, received, saved, ship, text_slices

# The rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "net")

LONG, SHORT = 16, 8
BEFORE, AFTER = 24, 8
WIDTH, FILTERS, HIDDEN = 5, 16, 16
#: Code points from here on are one character to the network; 0 stands for nothing.
CHARACTERS = 128
#: Findings and characters of a shard, about, and findings of either label that it has at least.
SHARD, SHARD_CHARACTERS, RARE = 2048, 1 << 22, 64
#: Rounds of learning, and steps of a round at least.
ROUNDS, STEPS, BATCH, RATE = 8, 75, 48, 0.005
#: Steps of a logit, and the largest one.
GRID, FARTHEST = 512, 64
#: A weight of 1 as a whole number.
ONE = 1 << 32
RECALL = 0.99
#: Calibration findings that a shape needs for a threshold of its own.
OWN_THRESHOLD = 30
#: Characters that the network works on at a time.
CELLS = 1 << 17
SPANS = "array<struct<kind:string,begin:int,end:int,score:double>>"
_SPAN = pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
_BODY = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_NAMED = r"""(?i)(password|passwd|secret|token|api_?key)["']? *[:=]"""


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """begin, number of the kind, end of the rules' matches, in the order of the output."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in characters]] = True
    return out


_IN_BODY, _DIGIT, _LETTER = _table(_BODY), _table(_BODY[52:62]), _table(_BODY[:52])


def candidate_runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte begins and ends of the candidates of several texts."""
    mask = _IN_BODY[data]
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    first[inner], last[inner - 1] = mask[inner], mask[inner - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    some = end - begin >= SHORT
    begin, end = begin[some], end[some]
    short = np.flatnonzero(end - begin < LONG)
    keep = np.ones(len(begin), bool)
    at = begin[short][:, None] + np.arange(LONG - 1)
    there = at < end[short][:, None]
    characters = data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else np.zeros(at.shape, np.uint8)
    keep[short] = (_DIGIT[characters] & there).any(1) & (_LETTER[characters] & there).any(1)
    return begin[keep], end[keep]


def _trimmed(text: str, begin: int, end: int) -> tuple[int, int]:
    """Without full stops and dashes at its ends, which belong to the sentence."""
    body = text[begin:end]
    return begin + len(body) - len(body.lstrip(".-")), end - len(body) + len(body.rstrip(".-"))


def _windows(texts: pa.Array, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, str, list[tuple[int, int, int]], list[tuple[int, int]]]]:
    """number, text, base spans, candidates of each text that has any."""
    begin, end = candidate_runs(data, bounds)
    owner = np.searchsorted(bounds, begin, "right") - 1
    named = pc.match_substring_regex(texts, _NAMED).to_numpy(zero_copy_only=False).astype(bool)
    for d in np.union1d(np.flatnonzero(named), owner):
        text = texts[int(d)].as_py()
        own = slice(*np.searchsorted(owner, [d, d + 1]))
        places = np.stack([begin[own], end[own]], 1) - bounds[d]
        if len(places) and len(text) < bounds[d + 1] - bounds[d]:  # bytes to code points
            starts = np.append(0, np.cumsum((data[bounds[d] : bounds[d + 1]] & 0xC0) != 0x80))
            places = starts[places]
        runs = (_trimmed(text, int(b), int(e)) for b, e in places)
        yield int(d), text, base_spans(text), [(b, e) for b, e in runs if e - b >= SHORT]


def _window(text: str, begin: int, end: int) -> tuple[str, str, str]:
    return text[max(0, begin - BEFORE) : begin], text[begin:end], text[end : end + AFTER]


def _covered(begin: int, end: int, spans: list[tuple[int, int, int]]) -> bool:
    return any(b < end and begin < e for b, _, e in spans)


def findings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """before, body, after, label of every candidate of the documents that may be learned from:
    1 if a rule covers it."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in text_slices(batch, "text"):
                rows = []
                for _, text, base, candidates in _windows(pc.fill_null(part.column("text"), ""), data, bounds):
                    rows += [(*_window(text, b, e), int(_covered(b, e, base))) for b, e in candidates]
                columns = list(zip(*rows)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns[:3]), pa.array(columns[3], pa.int32())], ["before", "body", "after", "label"])

    texts = docs.where(not_held_out(F.col(id_column))).select(F.col(text_column).alias("text"))
    return texts.mapInArrow(run, "before string, body string, after string, label int")


def _codes(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), CHARACTERS).astype(np.int64)


class _Laid:
    """Windows laid out in a row of characters, with gaps between them."""

    def __init__(self, windows: list[tuple[str, str, str]]):
        half = WIDTH // 2
        gap = "\0" * half
        self.codes = _codes(gap + gap.join("".join(w) + gap for w in windows) + gap)
        self.sizes = np.array([[len(part) for part in w] for w in windows], np.int64)
        #: Characters of each body, 1 at least.
        self.bodies = np.maximum(self.sizes[:, 1:2], 1).astype(np.float32)
        begins = np.cumsum(self.sizes.sum(1) + 2 * half) - self.sizes.sum(1) - 2 * half
        # The three parts of each window, in order.
        edges = begins[:, None] + np.concatenate([np.zeros((len(windows), 1), np.int64), np.cumsum(self.sizes, 1)], 1)
        self.begins, self.ends = edges[:, :3].ravel(), edges[:, 1:].ravel()

    def stretches(self) -> Iterator[tuple[int, np.ndarray]]:
        """The first place of a stretch, and the characters that its places see."""
        last = len(self.codes) - WIDTH + 1
        for at in range(0, last, CELLS):
            yield at, self.codes[at : min(at + CELLS, last) + WIDTH - 1]

    def parts(self, at: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The parts that lie in a stretch, in whole or not, and where."""
        b, e = np.clip(self.begins - at, 0, n), np.clip(self.ends - at, 0, n)
        some = np.flatnonzero(b < e)
        return some, b[some], e[some]


class Network:
    """The network's weights, calibration and thresholds."""

    def __init__(self, seed: int = 13):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        self.weights = {"conv": draw(WIDTH, CHARACTERS + 1, FILTERS), "bias": np.zeros(FILTERS, np.float32), "dense": draw(4 * FILTERS, HIDDEN), "shift": np.zeros(HIDDEN, np.float32), "out": draw(HIDDEN), "offset": np.zeros(1, np.float32)}
        self.weights["conv"][:, 0] = 0
        self.mean, self.root = ({k: np.zeros_like(v) for k, v in self.weights.items()} for _ in range(2))
        self.slope, self.move = 1.0, 0.0
        self.thresholds: dict[str, float] | None = None

    def head(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = self.weights
        hidden = np.maximum(pooled @ w["dense"] + w["shift"], 0)
        return hidden, hidden @ w["out"] + w["offset"][0]

    def pool(self, laid: _Laid) -> tuple[np.ndarray, np.ndarray]:
        """The largest of each part of each window, and the dense layer's input: all characters of
        all windows, in stretches of CELLS."""
        largest, total = np.zeros((len(laid.begins), FILTERS), np.float32), np.zeros((len(laid.sizes), FILTERS), np.float32)
        for at, codes in laid.stretches():
            active = self.convolve(codes)
            some, b, e = laid.parts(at, len(active))
            if len(some):
                padded = np.concatenate([active, np.zeros((1, FILTERS), np.float32)])
                # Between the parts lie only the gaps, which belong to none.
                pair = np.stack([b, e], 1).ravel()
                largest[some] = np.maximum(largest[some], np.maximum.reduceat(padded, pair)[::2])
                total[some[some % 3 == 1] // 3] += np.add.reduceat(padded, pair)[::2][some % 3 == 1]
        return largest, np.concatenate([largest[1::3], largest[0::3], largest[2::3], total / laid.bodies], 1)

    def logits(self, windows: list[tuple[str, str, str]]) -> np.ndarray:
        return self.head(self.pool(_Laid(windows))[1])[1].astype(float) if windows else np.zeros(0)

    def steps(self, windows: list[tuple[str, str, str]]) -> np.ndarray:
        """Logits as numbers of steps of 1 / GRID."""
        return np.rint(np.clip(self.logits(windows), -FARTHEST, FARTHEST) * GRID).astype(np.int64)

    def convolve(self, codes: np.ndarray) -> np.ndarray:
        n = len(codes) - WIDTH + 1
        out = np.repeat(self.weights["bias"][None], n, 0)
        for k in range(WIDTH):
            out += self.weights["conv"][k][codes[k : k + n]]
        return np.maximum(out, 0, out=out)

    def scores(self, windows: list[tuple[str, str, str]]) -> np.ndarray:
        """Calibrated probabilities."""
        return 1 / (1 + np.exp(-np.clip(self.slope * self.steps(windows) / GRID + self.move, -500, 500)))

    def gradients(self, windows: list[tuple[str, str, str]], labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The logistic loss and its derivatives, in stretches as well."""
        w, laid = self.weights, _Laid(windows)
        largest, flat = self.pool(laid)
        hidden, logit = self.head(flat)
        chance = 1 / (1 + np.exp(-np.clip(logit, -60, 60)))
        loss = float(-np.mean(np.where(labels > 0, np.log(chance + 1e-9), np.log(1 - chance + 1e-9))))
        d_logit = ((chance - labels) / len(labels)).astype(np.float32)
        d_hidden = d_logit[:, None] * w["out"] * (hidden > 0)
        body, before, after, mean = np.split(d_hidden @ w["dense"].T, 4, axis=1)
        d_largest, d_mean = np.stack([before, body, after], 1).reshape(-1, FILTERS), mean / laid.bodies
        taken = np.zeros(largest.shape, bool)
        out = {"bias": np.zeros_like(w["bias"]), "dense": flat.T @ d_hidden, "shift": d_hidden.sum(0), "out": hidden.T @ d_logit, "offset": d_logit.sum(keepdims=True), "conv": np.zeros_like(w["conv"])}
        for at, codes in laid.stretches():
            active = self.convolve(codes)
            some, b, e = laid.parts(at, len(active))
            owner = np.repeat(some, e - b)
            places = np.arange(len(owner)) + np.repeat(b - np.cumsum(e - b) + (e - b), e - b)
            slopes, inside = np.zeros(active.shape, d_mean.dtype), owner % 3 == 1
            slopes[places[inside]] = d_mean[owner[inside] // 3]
            # The first place of the largest, for each part and filter.
            own = active[places]
            i, f = np.nonzero((own == largest[owner]) & (own > 0) & ~taken[owner])
            first = np.unique(owner[i] * FILTERS + f, return_index=True)[1]
            i, f = i[first], f[first]
            slopes[places[i], f] += d_largest[owner[i], f]
            taken[owner[i], f] = True
            slopes *= active > 0
            out["bias"] += slopes.sum(0)
            for k in range(WIDTH):  # sums by character: in the order of the characters, one stretch each
                code = codes[k : k + len(active)]
                order = np.argsort(code, kind="stable")
                there, begin = np.unique(code[order], return_index=True)
                out["conv"][k][there] += np.add.reduceat(slopes[order], begin)
        out["conv"][:, 0] = 0
        return loss, out

    def learn(self, windows: list[tuple[str, str, str]], labels: np.ndarray, turn: int = 0, shard: int = 0) -> None:
        """One round of Adam: all findings, varied, half of each batch for each label; the findings
        of the rarer one come again and again."""
        rng = np.random.default_rng([13, turn, shard])
        sides = [x for x in (np.flatnonzero(labels == v) for v in (0, 1)) if len(x)]
        share = BATCH // len(sides)
        steps = max(STEPS, -(-max(map(len, sides)) // share))
        orders = [np.concatenate([rng.permutation(x) for _ in range(-(-steps * share // len(x)))]) for x in sides]
        for step in range(1, steps + 1):
            some = np.concatenate([order[(step - 1) * share : step * share] for order in orders])
            _, slopes = self.gradients([_varied(windows[k], labels[k], rng) for k in some], labels[some])
            rate, age = RATE * min(1.0, 2 * (1 - (turn + step / (steps + 1)) / ROUNDS)), turn * steps + step
            for k, g in slopes.items():
                self.mean[k] = 0.9 * self.mean[k] + 0.1 * g
                self.root[k] = np.sqrt(0.999 * self.root[k] ** 2 + 0.001 * g * g)
                self.weights[k] -= (rate * (self.mean[k] / (1 - 0.9**age)) / (self.root[k] / np.sqrt(1 - 0.999**age) + 1e-8)).astype(np.float32)

    def numbers(self) -> np.ndarray:
        """Weights and Adam's means as whole numbers, which have the same sum in any order."""
        return np.rint(np.concatenate([x.ravel().astype(float) for part in (self.weights, self.mean, self.root) for x in part.values()]) * ONE).astype(np.int64)

    def take(self, numbers: np.ndarray) -> None:
        """The weights and means that these numbers stand for (they need not be whole any more)."""
        at = 0
        for part in (self.weights, self.mean, self.root):
            for k, x in part.items():
                part[k] = (numbers[at : at + x.size] / ONE).astype(np.float32).reshape(x.shape)
                at += x.size

    def calibrate(self, logit: np.ndarray, labels: np.ndarray, shapes: np.ndarray, n: np.ndarray, odds: float, recall: float) -> None:
        """Platt scaling, the corpus's odds of a positive instead of the findings', thresholds:
        ``n`` findings each of a logit, label and shape."""
        n1, n0 = int(n[labels > 0].sum()), int(n[labels == 0].sum())
        target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        slope, move = 1.0, 0.0

        def loss(slope: float, move: float) -> float:
            x = slope * logit + move
            return float((n * (np.logaddexp(0, x) - target * x)).sum())

        for _ in range(50):  # Newton steps, halved until they help
            chance = 1 / (1 + np.exp(-np.clip(slope * logit + move, -60, 60)))
            weight, off = n * (chance * (1 - chance) + 1e-9), n * (chance - target)
            h = np.array([[(weight * logit * logit).sum() + 1e-6, (weight * logit).sum()], [(weight * logit).sum(), weight.sum() + 1e-6]])
            d, size = np.linalg.solve(h, [(off * logit).sum(), off.sum()]), 1.0
            while size > 1e-6 and loss(slope - size * d[0], move - size * d[1]) > loss(slope, move):
                size /= 2
            if size <= 1e-6:
                break
            slope, move = slope - size * d[0], move - size * d[1]
        self.slope, self.move = max(float(slope), 1e-3), float(move) + float(np.log(odds * (n0 + 1) / (n1 + 1)))
        positive = labels > 0
        odds_of = self.slope * logit + self.move

        def highest(own: np.ndarray) -> float:
            """The highest threshold that keeps the wanted share of these, and its margin."""
            if not own.any():
                return 1.0
            order = np.argsort(odds_of[own], kind="stable")
            up_to = np.cumsum(n[own][order])
            least = odds_of[own][order][np.searchsorted(up_to, np.floor((1 - recall) * up_to[-1]), "right")]
            below = odds_of[odds_of < least]
            return float(1 / (1 + np.exp(-(least + (below.max() if len(below) else least - 2)) / 2)))

        own = {s: positive & (shapes == s) for s in ("hex", "upper", "mixed")}
        self.thresholds = {s: highest(x if n[x].sum() >= OWN_THRESHOLD else positive) for s, x in own.items()}


_HEX_BODY, _UPPER_BODY = re.compile(r"[0-9a-fA-F]+"), re.compile(r"[A-Z0-9]+")
_ALPHABETS = ["0123456789abcdef", "0123456789ABCDEF", _BODY[:26] + _BODY[52:62], _BODY[:62], _BODY[:64], _BODY[:62] + "_-"]


def shape(body: str) -> str:
    return "hex" if _HEX_BODY.fullmatch(body) else "upper" if _UPPER_BODY.fullmatch(body) else "mixed"


def _varied(window: tuple[str, str, str], label: int, rng: np.random.Generator) -> tuple[str, str, str]:
    """A finding as the network gets it once: body drawn anew, text before hidden, or as it is."""
    before, body, after = window
    if label and rng.random() < 0.5:
        alphabet = np.array(list(_ALPHABETS[rng.integers(len(_ALPHABETS))]))
        body = "".join(rng.choice(alphabet, rng.integers(20, 65)))
    if rng.random() < 0.25:
        before = ""
    if (case := rng.random()) < 0.2:
        before, body, after = (x.upper() if case < 0.1 else x.lower() for x in (before, body, after))
    return before, body, after


def _of(table: pa.Table | pa.RecordBatch) -> list[tuple[str, str, str]]:
    return list(zip(*(table.column(c).to_pylist() for c in ("before", "body", "after"))))


def dealt(rows: DataFrame, counts: dict[int, int], shards: int) -> DataFrame:
    """Findings (with their ``key``) and their ``shard``; those of a rare label in several shards."""
    copies = [min(shards, -(-RARE * shards // counts[label])) for label in (0, 1)]
    last = F.when(F.col("label") == 0, copies[0] - 1).otherwise(copies[1] - 1)
    return rows.withColumn("shard", F.explode(F.transform(F.sequence(F.lit(0), last), lambda k: F.pmod(F.pmod("key", F.lit(shards)) + k, F.lit(shards)))))


def _round(findings: DataFrame, net: Network, turn: int) -> None:
    """Every shard learns from all its findings, and the network becomes the shards' mean."""
    shared = ship(findings.sparkSession, net)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        own = received(Network, shared)
        own.take(own.numbers())  # a copy
        table = table.sort_by([(c, "ascending") for c in ("before", "body", "after", "label")])
        own.learn(_of(table), table.column("label").to_numpy(), turn, key[0].as_py())
        numbers = own.numbers()
        return pa.table({"place": pa.array(np.arange(len(numbers), dtype=np.int32)), "number": pa.array(numbers)})

    found = findings.groupBy("shard").applyInArrow(run, "place int, number long").groupBy("place").agg(F.sum("number").alias("total"), F.count("*").alias("n")).toArrow().sort_by("place")
    net.take(found.column("total").to_numpy() / found.column("n").to_numpy())


def fit(labelled: DataFrame, recall: float = RECALL) -> Network:
    """Learn from findings: before, body, after, label (null labels and parts take no part)."""
    rows = labelled.dropna(subset=["before", "body", "after", "label"]).where("body <> '' and label in (0, 1)").select("before", "body", "after", "label").distinct()
    key = F.xxhash64("before", "body", "after")
    # The texts are read once for all counts and rounds.
    rows = saved(rows.select("*", key.alias("key"), (F.pmod(F.shiftrightunsigned(key, 40), F.lit(4)) == 3).alias("held")), "findings")
    seen = {(r.label, r.held): r for r in rows.groupBy("label", "held").agg(F.count("*").alias("n"), F.sum(F.length("body") + BEFORE + AFTER).alias("characters")).collect()}
    counts = [sum(r.n for r in seen.values() if r.label == v) for v in (0, 1)]
    net = Network()
    if not all(counts):
        return net
    # Where a label is missing on either side, all findings are on both.
    apart = len(seen) == 4
    taught, held = (rows.where("not held"), rows.where("held")) if apart else (rows, rows)
    own = [r for r in seen.values() if not (apart and r.held)]
    shards = -(-max(sum(r.n for r in own) * SHARD_CHARACTERS, sum(r.characters for r in own) * SHARD) // (SHARD * SHARD_CHARACTERS))
    findings = dealt(taught, {v: sum(r.n for r in own if r.label == v) for v in (0, 1)}, shards)
    for turn in range(ROUNDS):
        _round(findings, net, turn)
    net.mean, net.root = {}, {}
    at = _logits(held, net).groupBy("label", "shape", "at").count().toArrow().sort_by([(c, "ascending") for c in ("label", "shape", "at")])
    net.calibrate(at.column("at").to_numpy() / GRID, at.column("label").to_numpy(), np.array(at.column("shape").to_pylist()), at.column("count").to_numpy(), counts[1] / counts[0], recall)
    return net


def _logits(findings: DataFrame, net: Network) -> DataFrame:
    """label, shape, logit in steps of each finding."""
    bounded_batches(findings.sparkSession)
    shared = ship(findings.sparkSession, net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(Network, shared)
        for batch in batches:
            for part, _, _ in text_slices(batch, "body"):
                shapes = [shape(body) for body in part.column("body").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(shapes, pa.string()), pa.array(own.steps(_of(part)))], ["label", "shape", "at"])

    return findings.select("before", "body", "after", "label").mapInArrow(run, "label int, shape string, at long")


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Network:
    """Learn from what the rules find in the documents that may be learned from."""
    return fit(findings(docs, id_column, text_column))


def scan(docs: DataFrame, net: Network, text_column: str = "text") -> tuple[DataFrame, str]:
    """All columns of ``docs`` and an array of spans (its name is returned too): kind, begin,
    end, and the network's score (null for base spans)."""
    bounded_batches(docs.sparkSession)
    name, shared = free_name(docs, "spans"), ship(docs.sparkSession, net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(Network, shared)
        for batch in batches:
            for part, data, bounds in text_slices(batch, text_column):
                spans: list[list[tuple]] = [[] for _ in range(part.num_rows)]
                asked, windows = [], []
                for d, text, base, candidates in _windows(pc.fill_null(part.column(text_column), ""), data, bounds):
                    spans[d] = [(b, kind, e, None) for b, kind, e in base]
                    free = [(b, e) for b, e in candidates if own.thresholds and not _covered(b, e, base)]
                    asked += [(d, b, e) for b, e in free]
                    windows += [_window(text, b, e) for b, e in free]
                for (d, b, e), w, score in zip(asked, windows, own.scores(windows)):
                    if score >= own.thresholds[shape(w[1])]:
                        spans[d].append((b, 3, e, float(score)))
                rows = [[{"kind": KINDS[kind], "begin": b, "end": e, "score": score} for b, kind, e, score in sorted(one, key=lambda s: s[:3])] for one in spans]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, pa.list_(_SPAN))], [*part.schema.names, name])

    schema = docs.sparkSession.createDataFrame([], docs.schema).selectExpr("*", f"cast(null as {SPANS}) as `{name}`").schema
    return docs.mapInArrow(run, schema), name


def digests(docs: DataFrame, net: Network, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: n_assign, n_access, n_hex, base_sha256, spans, n_added."""
    found, name = scan(docs.select(id_column, text_column), net, text_column)
    spans = F.col(name)
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    listed = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")
    base = listed(F.filter(spans, lambda s: s["kind"] != "net"))
    return found.select(id_column, *[count(k).alias(f"n_{k}") for k in KINDS[:3]], F.sha2(base, 256).alias("base_sha256"), listed(spans).alias("spans"), count("net").alias("n_added"))
