"""Language identification by cross-parsing entropy (op 2).

Labelled text of each language becomes a suffix automaton, which knows all its substrings. A
text is parsed greedily into the longest phrases that occur in a language's sample; few
phrases mean a close language. A language's cost is phrases * log2(sample size) / length,
so that samples of different sizes compare; the least cost wins.

The automaton is a table over (state, symbol). Where no longer match exists the entry holds,
bit-inverted, the state after a fresh start, so that a parse is one table look-up a symbol
and many texts are parsed side by side. For that, texts are cut into segments of SEGMENT
symbols; afterwards the state at a segment's end is carried into the next one, which is
parsed again until both parses are in the same state, so the phrases are those of the whole
text.

Symbols are the bytes of the lower-cased text, other ASCII than letters being one symbol
that does not repeat. The sample of a language is bounded: of its different texts with a
letter, the TEXTS with the smallest hashes give an equal share of SAMPLE symbols, each from a
place in its text that the hash chooses, or from its first letter on if there is none at that
place (fewer symbols if there are so many languages that the tables would exceed TABLE_BYTES).
So every language that has a text with a letter is learned, however often rows repeat; more
than LANGUAGES languages are an error. Prediction covers every text whole. Texts that are null
or have no letter are ``und`` with score 0, and so is every text if nothing was learned. Null
labels are not learned from. Repeated rows and null ids are predicted each, and equal texts of
a language are learned from once; empty tables stay empty.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, free_name, not_held_out, received, ship, text_slices

#: Bound on the labelled symbols a language's automaton is built from.
SAMPLE = 32_768
#: Rows of each language that share it.
TEXTS = 60
#: Bound on the number of languages, and on the bytes of all their tables, which are broadcast.
LANGUAGES = 512
TABLE_BYTES = 256 << 20
SEGMENT = 512
#: Segments that are parsed side by side as long as there are more of them.
FEW = 24
#: Text bytes that are parsed at a time (a longer text is parsed alone).
SLICE = 1 << 20
#: How sharply a difference of a bit a symbol counts in the score.
SHARPNESS = 10.0
#: Bits that a symbol takes as it is; a text that the best language's sample describes in no
#: fewer is in no known language.
SYMBOL_BITS = 8
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
#: Texts that have symbols to learn from.
_LETTERED = r"[A-Za-z]|[^\x00-\x7F]"

_CODE = np.zeros(256, np.uint8)
_CODE[97:123] = np.arange(1, 27)
_CODE[128:] = np.arange(27, 155)


def symbols(text: str) -> np.ndarray:
    """The symbols of a text: 0 for a run of ASCII that holds no letter."""
    code = _CODE[np.frombuffer(text.lower().encode(), np.uint8)]
    keep = code > 0
    keep[1:] |= code[:-1] > 0
    return code[keep]


def automaton(sample: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is its start."""
    steps, link, longest, last = [{}], [-1], [0], 0
    for symbol in sample.tolist():
        state = len(steps)
        steps.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        at = last
        while at >= 0 and symbol not in steps[at]:
            steps[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = steps[at][symbol]
            if longest[target] == longest[at] + 1:
                link[state] = target
            else:
                copy = len(steps)
                steps.append(dict(steps[target]))
                link.append(link[target])
                longest.append(longest[at] + 1)
                while at >= 0 and steps[at].get(symbol) == target:
                    steps[at][symbol] = copy
                    at = link[at]
                link[target] = link[state] = copy
        last = state
    return steps


def parse_table(sample: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """The automaton as a flat table over alphabet columns; states are multiplied by its width.

    The last state stands before a phrase: every symbol begins one there. A symbol that the
    sample lacks is a phrase of its own, with the next phrase to begin after it.
    """
    width = int(alphabet.max()) + 1
    steps = automaton(alphabet[sample])
    table = np.full((len(steps) + 1, width), -1, np.int32)
    for state, known in enumerate(steps):
        table[state, list(known)] = list(known.values())
    fresh = np.where(table[0] >= 0, table[0], len(steps)) * width
    return np.where(table >= 0, table * width, ~fresh).astype(np.int32).ravel()


def _segments(table: np.ndarray, fresh: int, flat: np.ndarray, begin: np.ndarray, length: np.ndarray, live: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Phrases that begin in each segment, in one language."""
    state, count = np.full(len(begin), fresh, np.int32), np.zeros(len(begin), np.int64)
    passed = np.zeros((int((live > 0).sum()), len(begin)), np.int32)  # the state of every segment after each symbol
    for k in range(len(passed)):
        n = live[k]
        found = table[state[:n] + flat[begin[:n] + k]]
        sign = found >> 31
        count[:n] -= sign
        state[:n] = found ^ sign
        passed[k] = state
    # Segments that follow another start in its last state instead, until both parses agree.
    source = np.flatnonzero(following >= 0)
    starts = np.full(len(begin), fresh, np.int32)
    one = _One(table, flat, begin, length, state, count, passed)
    while len(source):
        where, given = following[source], state[source]
        open_ = starts[where] != given
        where, given = where[open_], given[open_]
        old, starts[where] = starts[where], given
        changed = []
        for k in range(len(passed)):
            if len(where) <= FEW:
                break
            inside = length[where] > k
            if not inside.all():
                ended = where[~inside]
                state[ended] = given[~inside]
                changed.append(ended)
                where, given, old = where[inside], given[inside], old[inside]
            symbol = flat[begin[where] + k]
            found, before = table[given + symbol], table[old + symbol]
            sign = found >> 31
            count[where] += (before >> 31) - sign
            given, old = found ^ sign, passed[k][where]
            passed[k][where] = given
            apart = given != old
            where, given, old = where[apart], given[apart], old[apart]
        else:
            k = len(passed)
        # A few that stay apart, and then what follows them in their texts, are parsed one by one.
        late = [w for w, g, o in zip(where.tolist(), given.tolist(), old.tolist()) if one.agrees_late(w, g, o, k)]
        for w in late:
            while (after := int(following[w])) >= 0 and (g := int(state[w])) != (o := int(starts[after])):
                starts[after] = g
                if not one.agrees_late(after, g, o, 0):
                    break
                w = after
        source = np.concatenate(changed) if changed else where[:0]
        source = source[following[source] >= 0]
    return count


class _One:
    """Parses a single segment on, symbol by symbol, through views that read plain numbers."""

    def __init__(self, table, flat, begin, length, state, count, passed):
        self.table, self.flat, self.passed = memoryview(table), memoryview(flat), memoryview(passed)
        self.begin, self.length, self.state, self.count = begin, length, state, count

    def agrees_late(self, segment: int, given: int, old: int, k: int) -> bool:
        """From symbol k on in the state ``given`` instead of ``old``: is its end another one?"""
        table, passed, at, n, more = self.table, self.passed, int(self.begin[segment]), int(self.length[segment]), 0
        while k < n:
            symbol = self.flat[at + k]
            found, before = table[given + symbol], table[old + symbol]
            more += (found < 0) - (before < 0)
            given, old = (~found if found < 0 else found), passed[k, segment]
            passed[k, segment] = given
            if given == old:
                self.count[segment] += more
                return False
            k += 1
        self.count[segment] += more
        self.state[segment] = given
        return True


class Model:
    """Parse tables of all languages."""

    def __init__(self, samples: dict[str, np.ndarray]):
        self.languages = sorted(samples)
        used = np.zeros(256, bool)
        for sample in samples.values():
            used[sample] = True
        # Column 0 is for symbols that no sample has; they begin no phrase anywhere.
        self.alphabet = np.where(used, np.cumsum(used), 0).astype(np.int32)
        self.tables = [parse_table(samples[x], self.alphabet) for x in self.languages]
        self.begin = [len(t) - int(self.alphabet.max()) - 1 for t in self.tables]
        self.bits = np.array([np.log2(len(samples[x]) + 2) for x in self.languages])

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """How many phrases each text needs in each language."""
        sizes = np.array([len(x) for x in texts], np.int64)
        parts = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), parts)
        begin = (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * SEGMENT + np.repeat(np.cumsum(sizes) - sizes, parts)
        length = np.minimum(SEGMENT, np.repeat(np.cumsum(sizes), parts) - begin)
        order = np.argsort(-length, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        after = np.append(owner[1:] == owner[:-1], False)
        # Of each segment, by length: where its text's next one is among them (-1: nowhere).
        following = np.where(after[order], rank[np.minimum(order + 1, len(order) - 1)], -1) if len(order) else order
        owner, begin, length = owner[order], begin[order], length[order]
        flat = self.alphabet[np.concatenate(texts)] if texts else np.zeros(0, np.int32)
        live = np.searchsorted(-length, -np.arange(1, SEGMENT + 1), "right")
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        for j, (table, fresh) in enumerate(zip(self.tables, self.begin)):
            out[:, j] = np.bincount(owner, _segments(table, fresh, flat, begin, length, live, following), len(texts)).astype(np.int64)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Each text's language, its score, and whether the text is in a known language at all."""
        lettered = np.array([bool(t) and _LETTER.search(t) is not None for t in texts], bool)
        found, score, known = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        if not self.languages or not lettered.any():
            return found, score, known
        rows = np.flatnonzero(lettered)
        coded = [symbols(texts[k]) for k in rows]
        sizes = np.maximum([len(x) for x in coded], 1)
        phrases = self.phrases(coded)
        cost = phrases * self.bits / sizes[:, None]
        best = cost.argmin(1)
        weight = np.exp(-SHARPNESS * (cost - cost.min(1, keepdims=True)))
        score[rows] = 1 / weight.sum(1)
        for k, b in zip(rows, best):
            found[k] = self.languages[b]
        # The text's end cuts its last phrase short: that one does not count against it.
        known[rows] = (phrases[np.arange(len(rows)), best] - 1) * self.bits[best] < SYMBOL_BITS * sizes
        return found, score, known


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", learnable: Column | None = None) -> Model:
    """Build the automata from a bounded sample of the labelled rows that may be learned from."""
    rule = not_held_out(F.col(id_column)) if learnable is None else learnable
    order = F.xxhash64(text_column)
    rows = docs.where(rule & F.col(lang_column).isNotNull() & F.col(text_column).rlike(_LETTERED)).select(F.col(lang_column).alias("lang"), order.alias("order"), F.col(text_column).alias("text"))
    # Hashes alone are shuffled, each once, and the first TEXTS of each language come here.
    first = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    hashes = rows.select("lang", "order").distinct().withColumn("first", first).where(F.col("first") <= TEXTS).select("lang", "order")
    chosen = hashes.limit(LANGUAGES * TEXTS + 1).collect()
    count = Counter(r[0] for r in chosen)
    if len(count) > LANGUAGES or len(chosen) > LANGUAGES * TEXTS:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not chosen:
        return Model({})
    # A state and its clone for each symbol, at most, with a column for each of 155 symbols.
    size = min(SAMPLE, TABLE_BYTES // (len(count) * 2 * 155 * 4))
    # An equal share of each text, with room for symbols of several bytes and dropped ones.
    wanted = docs.sparkSession.createDataFrame([(r[0], r[1], -(-2 * size // count[r[0]])) for r in chosen], "lang string, order bigint, share int")
    picked = rows.join(F.broadcast(wanted), ["lang", "order"])  # TEXTS rows a language
    start = 1 + F.pmod(F.xxhash64("order"), F.greatest(F.lit(1), F.length("text") - F.col("share") + 1)).cast("int")
    there = F.substring("text", start, F.col("share"))
    part = F.when(there.rlike(_LETTERED), there).otherwise(F.substring("text", F.regexp_instr("text", F.lit(f"({_LETTERED})")), F.col("share")))
    taken: dict[str, list] = {}
    for r in picked.select("lang", "order", part.alias("part")).groupBy("lang", "order").agg(F.min("part").alias("part")).orderBy("lang", "order").collect():
        taken.setdefault(r[0], []).append(symbols(r[2] + " "))
    samples = {}
    for k, v in taken.items():
        each = -(-size // len(v))
        samples[k] = np.concatenate([x[:each] for x in v])[:size]
    return Model(samples)


def predict(docs: DataFrame, model: Model, text_column: str = "text") -> tuple[DataFrame, str, str]:
    """All columns, the predicted language and its score; the new columns' names are returned too."""
    found, lang, score, known = _judged(docs, model, text_column)
    return found.drop(known), lang, score


def _judged(docs: DataFrame, model: Model, text_column: str) -> tuple[DataFrame, str, str, str]:
    bounded_batches(docs.sparkSession)
    lang, score, known = free_name(docs, "lang_pred"), free_name(docs, "score"), free_name(docs, "known")
    shared = ship(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(Model, shared)
        for batch in batches:
            for part, _, _ in text_slices(batch, text_column, SLICE):
                found, scores, sure = own.predict(part.column(text_column).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string()), pa.array(scores), pa.array(sure)], [*part.schema.names, lang, score, known])

    schema = docs.sparkSession.createDataFrame([], docs.schema).selectExpr("*", f"cast(null as string) as `{lang}`", f"cast(null as double) as `{score}`", f"cast(null as boolean) as `{known}`").schema
    return docs.mapInArrow(run, schema), lang, score, known


def accepted(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The documents of a known language; ``und`` ones go, and those that no sample explains."""
    found, lang, score, known = _judged(docs, model, text_column)
    return found.where(known).drop(lang, score, known)
