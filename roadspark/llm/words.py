"""Words of many texts at once: numpy over the bytes of an Arrow batch.

Words and shingles are compared by 64-bit hashes: a sum of byte values, each times a
pseudo-random number of its place, then a finaliser. Words with a structure that defeats
polynomial hashes do not collide; other collisions have a probability of about 2^-56 a pair.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Bytes that words are split from at a time; a longer text is cut between words.
PIECE = 2 << 20


def word_table(separators: str) -> tuple[np.ndarray, np.ndarray]:
    """Per byte: does it belong to a word, and its value with A-Z lower-cased."""
    inside = np.ones(256, bool)
    inside[[ord(c) for c in separators]] = False
    value = np.arange(256, dtype=np.uint64)
    value[65:91] += _U(32)
    return inside, value + _U(1)


#: Words of letters, digits and everything beyond ASCII; A-Z count as a-z.
ALNUM = word_table("".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])))
#: Words between ASCII white space.
SPACED = word_table(" \t\n\v\f\r")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (public-domain SplitMix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def factors(n: int) -> np.ndarray:
    """A fixed odd number for each of the first ``n`` places."""
    global _FACTORS
    if len(_FACTORS) < n:
        _FACTORS = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)
    return _FACTORS[:n]


_FACTORS = np.zeros(0, np.uint64)


def split_words(data: np.ndarray, bounds: np.ndarray, table: tuple[np.ndarray, np.ndarray] = ALNUM) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (64 bits), and where each text's words begin (one more entry than texts).

    A word never crosses the end of its text.
    """
    found, word_at, at = [], np.zeros(len(bounds), np.int64), 0
    while at < len(data) or not found:
        to = min(at + PIECE, len(data))
        while to < len(data) and table[0][data[to]]:  # not within a word
            gaps = np.flatnonzero(~table[0][data[to : to + PIECE]])
            to = to + int(gaps[0]) if len(gaps) else min(to + PIECE, len(data))
        words, begin = _split(data[at:to], np.clip(bounds - at, 0, to - at), table)
        found.append(words)
        word_at += begin
        at = max(to, at + 1)
    return np.concatenate(found), word_at


def _split(data: np.ndarray, bounds: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    inside, value = table
    mask = inside[data]
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    edge = bounds[:-1][bounds[:-1] < len(data)]
    first[edge] = mask[edge]
    starts = np.flatnonzero(first)
    word_at = np.searchsorted(starts, bounds).astype(np.int64)
    if not len(starts):
        return np.empty(0, np.uint64), word_at
    where = np.flatnonzero(mask)
    begin = np.searchsorted(where, starts) if len(where) < 4 * len(starts) else np.flatnonzero(first[where])
    lengths = np.diff(np.append(begin, len(where)))
    place = np.arange(len(where)) - np.repeat(begin, lengths)
    terms = value[data[where]] * factors(int(lengths.max()))[place]
    return mix(np.add.reduceat(terms, begin)), word_at


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on (the last ones are short and meaningless)."""
    out = np.zeros(len(words), np.uint64)
    for k, p in enumerate(factors(size)):
        out[: len(words) - k] += words[k:] * p if k < len(words) else _U(0)
    return mix(out)


def shingle_sets(words: np.ndarray, word_at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct ``size``-word shingles, sorted, and where each text's set begins.

    A text of fewer words, but not none, has the sequence of all its words as its only shingle.
    """
    counts = np.diff(word_at)
    hashed = windows(words, size) if len(words) else words
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(words)) - np.repeat(word_at[:-1], counts)
    keep = place <= np.repeat(counts, counts) - size
    short = np.flatnonzero((counts > 0) & (counts < size))
    values, owner = hashed[keep], doc[keep]
    if len(short):
        whole = []
        for d in short:  # at most size - 1 words each
            w = words[word_at[d] : word_at[d + 1]]
            whole.append(mix(np.array([(w * factors(len(w))).sum(dtype=np.uint64) + _U(len(w))], np.uint64))[0])
        values, owner = np.append(values, np.array(whole, np.uint64)), np.append(owner, short)
    out, sizes = [], np.zeros(len(counts), np.int64)
    order = np.argsort(owner, kind="stable") if len(short) else slice(None)
    values, owner = values[order], owner[order]
    ends = np.searchsorted(owner, np.arange(len(counts) + 1))
    for d in range(len(counts)):
        one = values[ends[d] : ends[d + 1]]
        if len(one) > 1:
            one = np.sort(one)
            one = one[np.append(True, one[1:] != one[:-1])]
        sizes[d] = len(one)
        out.append(one)
    return np.concatenate(out) if out else values, np.append(0, np.cumsum(sizes))
