"""Suffix sort by hash comparison, as array work.

Prefix sums of a polynomial over the bytes (modulo 2**64, with a random value
for each byte) give the hash of any substring in two reads. The common
extension of two suffixes is found by binary search over hash equality, so one
comparison takes a logarithmic number of steps; a bottom-up mergesort places
each suffix of a run by binary search in its neighbour run. Hash equality is
not trusted: ``equal_bytes`` compares the bytes.
"""

from __future__ import annotations

import numpy as np

from .shingles import Powers, mix64

_BYTE = np.random.default_rng(6).integers(0, 1 << 64, 256, np.uint64)


class PrefixHash:
    """Substring hashes of a byte array, of ``bits`` bits (fewer make collisions: for tests)."""

    def __init__(self, data: np.ndarray, bits: int = 64):
        self.data, self.mask = data, np.uint64((1 << bits) - 1)
        up, self.down = Powers.upto(len(data) + 1)
        self.sums = np.empty(len(data) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(_BYTE[data] * up[:len(data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, length) -> np.ndarray:
        return mix64((self.sums[start + length] - self.sums[start]) * self.down[start]) & self.mask

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        s, d = self.sums, self.down
        return (s[a + length] - s[a]) * d[a] == (s[b + length] - s[b]) * d[b]

    def lce(self, a: np.ndarray, b: np.ndarray, cap: np.ndarray) -> np.ndarray:
        """Longest common extension of suffixes a and b, ``cap`` at most."""
        low, high = np.zeros(len(a), np.int64), cap.astype(np.int64).copy()
        whole = self.same(a, b, high)
        low[whole] = high[whole]
        live = np.flatnonzero(~whole)
        high[live] -= 1
        while len(live):
            live = live[low[live] < high[live]]
            mid = (low[live] + high[live] + 1) >> 1
            ok = self.same(a[live], b[live], mid)
            low[live[ok]] = mid[ok]
            high[live[~ok]] = mid[~ok] - 1
        return low

    def less(self, a, cap_a, b, cap_b) -> tuple[np.ndarray, np.ndarray]:
        """Whether suffix a sorts before suffix b, and whether they are equal;
        suffix x is ``cap_x`` bytes long."""
        cap = np.minimum(cap_a, cap_b)
        at = self.lce(a, b, cap)
        inside = at < cap
        x = self.data[np.where(inside, a + at, 0)].astype(np.int64) if len(self.data) else np.zeros(len(a), np.int64)
        y = self.data[np.where(inside, b + at, 0)].astype(np.int64) if len(self.data) else np.zeros(len(a), np.int64)
        return np.where(inside, x < y, cap_a < cap_b), ~inside & (cap_a == cap_b)

    def equal_bytes(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        """Whether ``length`` bytes from a and b are equal, byte by byte."""
        out = np.empty(len(a), bool)
        span = np.arange(length)
        for lo in range(0, len(a), 8192):
            x, y = a[lo:lo + 8192, None] + span, b[lo:lo + 8192, None] + span
            out[lo:lo + 8192] = (self.data[x] == self.data[y]).all(axis=1)
        return out

    def sort(self, start: np.ndarray, cap: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Order of the suffixes (of ``cap`` bytes each) inside their segments;
        equal ones stay in the given order."""
        order = np.argsort(segment, kind="stable")
        seg = segment[order]
        first = np.concatenate([[True], seg[1:] != seg[:-1]]) if len(seg) else np.empty(0, bool)
        begin = np.flatnonzero(first)
        size = np.diff(np.concatenate([begin, [len(seg)]]))
        seg_begin, seg_size = np.repeat(begin, size), np.repeat(size, size)
        width, longest = 1, int(size.max(initial=0))
        while width < longest:
            at = np.flatnonzero(seg_size > width)
            place = at - seg_begin[at]
            run = place // width
            other = run ^ 1
            base = seg_begin[at] + other * width
            count = np.clip(seg_size[at] - other * width, 0, width)
            low, high = np.zeros(len(at), np.int64), count.copy()
            mine = order[at]
            right = (run & 1) == 1  # a right run goes behind equal suffixes of its left run
            live = np.flatnonzero(low < high)
            while len(live):
                mid = (low[live] + high[live]) >> 1
                theirs = order[base[live] + mid]
                before, equal = self.less(start[theirs], cap[theirs], start[mine[live]], cap[mine[live]])
                before |= equal & right[live]
                low[live[before]] = mid[before] + 1
                high[live[~before]] = mid[~before]
                live = live[low[live] < high[live]]
            merged = order.copy()
            merged[seg_begin[at] + np.minimum(run, other) * width + (place - run * width) + low] = mine
            order, width = merged, width * 2
        return order
