"""Word shingles and MinHash signatures of text batches, as array work.

Words are the runs between white space of the lower-cased text. A shingle is
five words in a row; a text of one to four words has one shingle, all its words.
Shingles are 64-bit hashes: two different shingles of a pair of texts collide
with odds of about 2**-64 each.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WORDS = 5
HASHES = 128
_BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _spaces() -> np.ndarray:
    out = np.zeros(0x110000, bool)
    out[[c for c in range(0x110000) if chr(c).isspace()]] = True
    return out


class Powers:
    """Powers of the polynomial base and of its inverse modulo 2**64."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 20)
            step = np.full(size, _BASE, np.uint64)
            back = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
            step[0] = back[0] = 1
            cls.up, cls.down = np.cumprod(step), np.cumprod(back)
        return cls.up, cls.down


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of every text; first word of each text (n + 1)."""
    low = [t.lower() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in low])]).astype(np.int64)
    cp = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(cp)
    inside = ~_spaces()[cp]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~first[:n]
    after = np.concatenate([inside[1:], [False]]) & ~first[1:]
    begin, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    up, down = Powers.upto(n + 1)
    c = (cp.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    c ^= c >> np.uint64(32)
    c *= up[:n]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(c)])
    return mix64((sums[end] - sums[begin]) * down[begin]), np.searchsorted(begin, offsets)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of every text, with repeats; offsets (n + 1)."""
    words, at = word_hashes(texts)
    n_words = np.diff(at)
    n = len(words)
    roll = np.zeros(max(n - WORDS + 1, 0), np.uint64)
    for k in range(WORDS):
        roll = roll * np.uint64(_BASE) + words[k:k + len(roll)]
    counts = np.where(n_words >= WORDS, n_words - WORDS + 1, (n_words > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    starts = np.repeat(at[:-1] - offsets[:-1], counts) + np.arange(offsets[-1])
    out = roll[np.minimum(starts, max(len(roll) - 1, 0))] if len(roll) else np.zeros(offsets[-1], np.uint64)
    for row in np.flatnonzero((n_words > 0) & (n_words < WORDS)):
        h = np.uint64(n_words[row])
        for w in words[at[row]:at[row + 1]]:
            h = np.uint64((int(h) * _BASE + int(w)) % (1 << 64))
        out[offsets[row]] = h
    return mix64(out), offsets


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return (rng.integers(0, 1 << 64, HASHES, np.uint64) | np.uint64(1)), rng.integers(0, 1 << 64, HASHES, np.uint64)


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash signature (HASHES x u32) of each text that has a shingle; the
    rows of other texts are all ones."""
    n = len(offsets) - 1
    out = np.full((n, HASHES), 0xFFFFFFFF, np.uint32)
    rows = np.flatnonzero(np.diff(offsets))
    if len(rows):
        starts = offsets[rows]
        for k, (a, b) in enumerate(zip(*_functions())):
            out[rows, k] = np.minimum.reduceat(((hashes * a + b) >> np.uint64(32)).astype(np.uint32), starts)
    return out
