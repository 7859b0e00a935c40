"""Ragged values kept by the 64-bit hash of what they belong to (numpy, per worker).

An open-addressing table of hashes points into pooled values, so a batch is
looked up and gathered without a Python step per item.
"""

from __future__ import annotations

import numpy as np

from .textbytes import U


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, .. starts[i] + counts[i] - 1 for every i, in a row."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def _grown(array: np.ndarray, n: int) -> np.ndarray:
    if n <= len(array):
        return array
    out = np.zeros(max(n, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out


class Pool:
    """Values of all entries, one behind the other."""

    def __init__(self, dtype):
        self.values, self.used = np.zeros(1 << 12, dtype), 0
        self.starts, self.counts, self.n = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int32), 0

    def add(self, flat: np.ndarray, counts: np.ndarray) -> None:
        self.values, self.starts, self.counts = _grown(self.values, self.used + len(flat)), _grown(self.starts, self.n + len(counts)), _grown(self.counts, self.n + len(counts))
        self.values[self.used : self.used + len(flat)] = flat
        self.starts[self.n : self.n + len(counts)] = self.used + np.cumsum(counts) - counts
        self.counts[self.n : self.n + len(counts)] = counts
        self.used += len(flat)
        self.n += len(counts)

    def take(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts[entry].astype(np.int64)
        return self.values[spread(self.starts[entry], counts)], counts


class Memo:
    """Hash to entry number.  ``entries`` bounds what is kept between calls: beyond
    it all is dropped that was not met again since it came or since the last such
    drop (and what was, over half of the bound); it is met anew, which changes no result."""

    def __init__(self, dtypes: list, entries: int = 2_000_000):
        self.dtypes, self.entries = dtypes, entries
        self.clear()

    def clear(self) -> None:
        self.keys, self.entry, self.n = np.zeros(1 << 16, U), np.zeros(1 << 16, np.int32), 0
        self.again = np.zeros(1 << 16, bool)  # entries met again
        self.pools = [Pool(t) for t in self.dtypes]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 where there is none."""
        hashes = np.maximum(hashes, U(1))
        last = U(len(self.keys) - 1)
        out = np.full(len(hashes), -1, np.int64)
        left, slot = np.arange(len(hashes)), (hashes & last).astype(np.int64)
        while len(left):
            key = self.keys[slot]
            hit = key == hashes[left]
            out[left[hit]] = self.entry[slot[hit]]
            go = ~hit & (key != 0)
            left, slot = left[go], (slot[go] + 1) & int(last)
        return out

    def _place(self, hashes: np.ndarray, entry: np.ndarray) -> None:
        last = len(self.keys) - 1
        slot = (hashes & U(last)).astype(np.int64)
        while len(hashes):
            free = self.keys[slot] == 0
            _, one = np.unique(slot[free], return_index=True)  # one newcomer to a slot
            put = np.flatnonzero(free)[one]
            self.keys[slot[put]], self.entry[slot[put]] = hashes[put], entry[put]
            rest = np.ones(len(hashes), bool)
            rest[put] = False
            hashes, entry, slot = hashes[rest], entry[rest], slot[rest]
            slot = np.where(self.keys[slot] == 0, slot, (slot + 1) & last)

    def add(self, hashes: np.ndarray, columns: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """New distinct hashes with (values in a row, counts) for every pool."""
        hashes = np.maximum(hashes, U(1))
        if 2 * (self.n + len(hashes)) > len(self.keys):
            size = len(self.keys)
            while 2 * (self.n + len(hashes)) > size:
                size *= 2
            full = self.keys != 0
            keys, entry = self.keys[full], self.entry[full]
            self.keys, self.entry = np.zeros(size, U), np.zeros(size, np.int32)
            self._place(keys, entry)
        self._place(hashes, np.arange(self.n, self.n + len(hashes), dtype=np.int32))
        for pool, (flat, counts) in zip(self.pools, columns, strict=True):
            pool.add(flat, counts)
        self.n += len(hashes)
        self.again = _grown(self.again, self.n)

    def _thin(self) -> None:
        """Room for newcomers: only entries met again stay."""
        stay = np.flatnonzero(self.again[: self.n])[: self.entries // 2]
        full = self.keys != 0
        key = np.zeros(self.n, U)
        key[self.entry[full]] = self.keys[full]
        columns = [pool.take(stay) for pool in self.pools]
        self.clear()
        if len(stay):
            self.add(key[stay], columns)

    def entries_of(self, hashes: np.ndarray, learn) -> np.ndarray:
        """Entries of all hashes; ``learn(positions)`` gives the columns of
        those not met before (one position for each distinct hash)."""
        found = self.find(hashes)
        self.again[found[found >= 0]] = True
        lost = np.flatnonzero(found < 0)
        if len(lost) and self.n + len(lost) > self.entries and self.n:
            self._thin()
            found = self.find(hashes)
            lost = np.flatnonzero(found < 0)
        if len(lost):
            new, one, back = np.unique(hashes[lost], return_index=True, return_inverse=True)
            first = self.n
            self.add(new, learn(lost[one]))
            found[lost] = first + back
        return found
