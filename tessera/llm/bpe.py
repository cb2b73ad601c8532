"""Word splitting and word-wise encoding with a public byte-level BPE.

Byte-level BPE never merges across the words of its pre-tokenizer, so a text's
ids are the concatenation of its words' ids. Workers therefore split a text,
encode each word that is new to them with the ``tokenizers`` library, and put
the ids together by position with array gathers.

The words come from the pre-tokenizer's own pattern run by ``regex``. The two
regular-expression engines know different Unicode versions, so a text that
holds a code point outside ``SAFE`` is split by the library itself; on the
code points of ``SAFE`` both agree (tests/llm checks every one).
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import regex

from .shingles import Powers, mix64

# The published split pattern of the byte-level vocabulary, as
# public_tokenizers.PATTERN gives it.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
UNSAFE = regex.compile("[^\x00-՗Ḁ-⁰₠-₿℀-↋←-␦　-ヿ一-鿯가-힣\U0001f600-\U0001f64f]")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer, once per worker, without truncation or padding."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def _specials(path: str):
    """Pattern of the added tokens' strings (a text's occurrences are single ids)."""
    added = sorted((x.content for x in tokenizer(path).get_added_tokens_decoder().values()),
                   key=len, reverse=True)
    return regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None


def vocab_size(path: str) -> int:
    return tokenizer(path).get_vocab_size(with_added_tokens=True)


def split(text: str, path: str) -> list[str]:
    """Words of ``text`` in order; an added token's string is a word."""
    if not text:
        return []
    specials = _specials(path)
    if specials is not None and specials.search(text):
        out: list[str] = []
        for i, part in enumerate(specials.split(text)):
            out.extend([part] if i % 2 else _words(part, path))
        return out
    return _words(text, path)


def _words(text: str, path: str) -> list[str]:
    if UNSAFE.search(text) is None:
        return PATTERN.findall(text)
    pre = tokenizer(path).pre_tokenizer.pre_tokenize_str(text)
    return [text[a:b] for _, (a, b) in pre]


def encode_words(words: list[str], path: str) -> list[list[int]]:
    """Ids of each word, by the library."""
    t = tokenizer(path)
    return [e.ids for e in t.encode_batch_fast(words, add_special_tokens=False)] if words else []


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """0 other, 1 letter, 2 number, 3 white space, as the split pattern has them."""
    out = np.zeros(0x110000, np.uint8)
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\s+")):
        for m in regex.finditer(pattern, text):
            lo, hi = ord(text[m.start()]), ord(text[m.end() - 1])
            if lo < 0xD800 and hi >= 0xE000:  # a run over the surrogate gap
                out[lo:0xD800], lo = kind, 0xE000
            out[lo:hi + 1] = kind
    return out


def word_starts(texts: list[str], path: str) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """All texts joined, its code points, where each word starts (and the end),
    and the number of the first word of each text (n + 1).

    Follows the split pattern on runs of one character class:

    - a run of letters, numbers or others is a word; a space (U+0020) right
      before it belongs to it;
    - white space before such a run leaves its last character to the run (a
      space) or alone as a word (any other); the rest of it is one word;
    - white space at the end of a text is one word;
    - an apostrophe run of one, not after a space, takes a following s, t, re,
      ve, m, ll or d; what is left of those letters is a word.
    """
    joined = "".join(texts)
    off = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(cp)
    start = np.zeros(n + 1, bool)
    if n:
        kind = _classes()[cp]
        edge = np.zeros(n + 1, bool)  # a text begins here
        edge[off] = True
        space = kind == 3
        start[1:n] = kind[1:] != kind[:-1]
        start |= edge
        # the last of white space before other characters starts a word, and a
        # run after U+0020 does not
        before = space[:-1] & ~space[1:] & ~edge[1:n]
        at = np.flatnonzero(before)
        start[at] = True
        start[at[cp[at] == 0x20] + 1] = False
        quote = np.flatnonzero((cp[:-1] == 0x27) & start[:n - 1] & (kind[1:] == 1) & ~edge[1:n])
        if len(quote):
            # the apostrophe itself must start its word, so no space belongs to it
            two = np.append(cp, [0, 0])
            a, b = two[quote + 1], np.where(edge[np.minimum(quote + 2, n)], 0, two[quote + 2])
            short = np.isin(a, [ord(c) for c in "stmd"])
            long = np.zeros(len(quote), bool)
            for x, y in ("re", "ve", "ll"):
                long |= (a == ord(x)) & (b == ord(y))
            for which, size in ((short, 2), (long, 3)):
                q = quote[which]
                start[q + 1] = False
                rest = q + size
                rest = rest[rest < n]
                start[rest[(kind[rest] == 1)]] = True
        specials = _specials(path)
        odd = [i for i, t in enumerate(texts) if UNSAFE.search(t) or (specials and specials.search(t))]
        for i in odd:  # split by the library
            start[off[i]:off[i + 1]] = False
            lens = np.fromiter(map(len, split(texts[i], path)), np.int64)
            start[off[i] + np.cumsum(lens) - lens] = True
        start[n] = True
    at = np.flatnonzero(start)
    return joined, cp, at, np.searchsorted(at, off)


def word_keys(cp: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hash of each word (never 0), by prefix sums of a polynomial."""
    up, down = Powers.upto(len(cp) + 1)
    c = (cp.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    c ^= c >> np.uint64(32)
    c *= up[:len(cp)]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(c)])
    h = mix64((sums[at[1:]] - sums[at[:-1]]) * down[at[:-1]])
    return np.maximum(h, np.uint64(1))


class KeyIndex:
    """64-bit keys -> 0, 1, 2, ... in order of first use (an open table in numpy)."""

    def __init__(self, bits: int = 17):
        self.size = 0
        self._alloc(bits)

    def _alloc(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.zeros(1 << bits, np.uint64)
        self.vals = np.zeros(1 << bits, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 if it is new."""
        mask = np.int64((1 << self.bits) - 1)
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        got = self.keys[slot]
        out = np.where(got == keys, self.vals[slot], -1)
        live = np.flatnonzero((got != keys) & (got != 0))
        while len(live):
            slot[live] = (slot[live] + 1) & mask
            got = self.keys[slot[live]]
            hit = got == keys[live]
            out[live[hit]] = self.vals[slot[live[hit]]]
            live = live[~hit & (got != 0)]
        return out

    def _put(self, keys: np.ndarray, vals: np.ndarray) -> None:
        mask = np.int64((1 << self.bits) - 1)
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        live = np.arange(len(keys))
        while len(live):
            free = live[self.keys[slot[live]] == 0]
            self.keys[slot[free]] = keys[free]
            won = self.keys[slot[live]] == keys[live]
            self.vals[slot[live[won]]] = vals[live[won]]
            live = live[~won]
            slot[live] = (slot[live] + 1) & mask

    def add(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the keys; and the place of the first use of each new one."""
        out = self.find(keys)
        new = np.flatnonzero(out < 0)
        if not len(new):
            return out, new
        _, first, inverse = np.unique(keys[new], return_index=True, return_inverse=True)
        order = np.argsort(first, kind="stable")
        rank = np.empty(len(first), np.int64)
        rank[order] = np.arange(len(first))
        out[new] = self.size + rank[inverse]
        fresh = new[first[order]]
        if 2 * (self.size + len(fresh)) > 1 << self.bits:
            used = self.keys != 0
            keys_old, vals_old = self.keys[used], self.vals[used]
            self._alloc((2 * (self.size + len(fresh))).bit_length() + 1)
            self._put(keys_old, vals_old)
        self._put(keys[fresh], np.arange(self.size, self.size + len(fresh), dtype=np.int32))
        self.size += len(fresh)
        return out, fresh


class WordTable:
    """Ids of the words a worker has met; starts anew beyond ``max_words``."""

    def __init__(self, path: str, max_words: int = 600_000):
        self.path, self.max_words = path, max_words
        self._reset()

    def _reset(self) -> None:
        self.index = KeyIndex()
        self.flat = np.empty(1 << 16, np.int32)
        self.starts = np.zeros(1 << 15, np.int64)
        self.used = self.words = 0

    def _add(self, fresh: list[str]) -> None:
        for lo in range(0, len(fresh), 20_000):
            part = fresh[lo:lo + 20_000]
            ids = encode_words(part, self.path)
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((x for i in ids for x in i), np.int32, int(lens.sum()))
            n = self.words
            if self.used + len(flat) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.empty(max(len(self.flat), len(flat)), np.int32)])
            if n + len(part) + 1 > len(self.starts):
                self.starts = np.concatenate([self.starts, np.zeros(max(len(self.starts), len(part) + 1), np.int64)])
            self.flat[self.used:self.used + len(flat)] = flat
            self.starts[n + 1:n + 1 + len(part)] = self.used + np.cumsum(lens)
            self.used += len(flat)
            self.words += len(part)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the row offsets (n + 1)."""
        if self.words > self.max_words:
            self._reset()
        joined, cp, at, first = word_starts(texts, self.path)
        number, fresh = self.index.add(word_keys(cp, at)) if len(cp) else (np.empty(0, np.int64),) * 2
        if len(fresh):
            self._add([joined[a:b] for a, b in zip(at[fresh].tolist(), at[fresh + 1].tolist())])
        begin = self.starts[number]
        lens = self.starts[number + 1] - begin
        ends = np.concatenate([[0], np.cumsum(lens)])
        ids = self.flat[np.repeat(begin - ends[:-1], lens) + np.arange(int(ends[-1]))]
        return ids, ends[first]


_TABLES: dict[str, WordTable] = {}


def word_table(path: str) -> WordTable:
    """The worker's word table for a vocabulary (kept across its tasks)."""
    if path not in _TABLES:
        _TABLES[path] = WordTable(path)
    return _TABLES[path]


@lru_cache(maxsize=4)
def pieces(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Id-to-piece table: bytes of all pieces and offsets (ids + 1).

    The printable alphabet of byte-level vocabularies is undone here: printable
    Latin-1 characters stand for themselves, the other bytes in ascending order
    for U+0100 onwards. Added tokens stand for their own text.
    """
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    byte_of = {chr(b): b for b in keep} | {chr(0x100 + i): b for i, b in enumerate(rest)}
    t = tokenizer(path)
    added = t.get_added_tokens_decoder()
    vocab = {i: p for p, i in t.get_vocab(with_added_tokens=True).items()}
    out = []
    for i in range(max(vocab, default=-1) + 1):
        p = vocab.get(i, "")
        out.append(p.encode() if i in added else bytes(byte_of[c] for c in p))
    lens = np.fromiter(map(len, out), np.int64, len(out))
    return np.frombuffer(b"".join(out), np.uint8), np.concatenate([[0], np.cumsum(lens)])
