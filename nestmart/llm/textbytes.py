"""Vectorised text helpers on Arrow string columns (numpy, no per-word loop).

Texts stay the UTF-8 bytes that Arrow hands over.  The word rule
``[^\\x20\\x09-\\x0D]+`` only names ASCII separators, so splitting bytes gives
the same words as splitting characters.  Words and word windows are named by
64-bit hashes: a polynomial over the bytes (over the words) modulo 2**64 with
random byte weights, finished by a bijective mixer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Everything but ASCII letters, digits and non-ASCII bytes.
PUNCT = np.ones(256, bool)
PUNCT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_WEIGHTS = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept per process, grown when needed)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 12)
        have = np.empty(size, U)
        have[0] = 1
        filled = 1
        while filled < size:
            take = min(filled, size - filled)
            have[filled : filled + take] = have[:take] * U(pow(base, filled, 1 << 64))
            filled += take
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@dataclass
class Chunk:
    """Consecutive rows of one batch: rows lo..hi, their bytes and row offsets."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return self.hi - self.lo


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One Arrow array without nulls (null texts become empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "") if column.null_count else column


def chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a string column into runs of rows of about ``max_bytes`` bytes; a
    longer row is a run of its own."""
    column = plain(column)
    if len(column) == 0:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, where, body = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield Chunk(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


@dataclass
class Words:
    """Words of a chunk: hash, first byte and row of each; row r owns words
    first[r] .. first[r + 1]."""

    hashes: np.ndarray
    starts: np.ndarray
    row: np.ndarray
    first: np.ndarray


def words(chunk: Chunk, separators: np.ndarray = SPACE, fold: bool = False, extra_breaks: np.ndarray | None = None) -> Words:
    """Hash the words of a chunk.  ``fold`` lower-cases ASCII letters;
    ``extra_breaks`` are byte positions where a new word must begin."""
    data = LOWER[chunk.data] if fold else chunk.data
    inside = ~separators[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edges = chunk.offsets[:-1]
    edges = edges[edges < len(data)]
    begin[edges] = inside[edges]
    if extra_breaks is not None and len(extra_breaks):
        begin[extra_breaks] = inside[extra_breaks]
    starts = np.flatnonzero(begin)
    if len(starts) == 0:
        return Words(np.zeros(0, U), starts, np.zeros(0, np.int64), np.zeros(chunk.rows + 1, np.int64))
    value = _WEIGHTS[data]
    value *= powers(_BASE, len(data))
    value[~inside] = 0
    sums = np.add.reduceat(value, starts)
    sums *= powers(_INVERSE, len(data))[starts]
    first = np.searchsorted(starts, chunk.offsets)
    row = np.repeat(np.arange(chunk.rows), np.diff(first))
    return Words(mix(sums), starts, row, first)


def windows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of the first word, hash) of every run of k words of one row."""
    n = len(w.hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    at = np.flatnonzero(w.row[:n] == w.row[k - 1 :])
    if k <= 8:
        total = w.hashes[:n].copy()
        for j in range(1, k):
            total *= U(_BASE)
            total += w.hashes[j : n + j]
    else:
        sums = np.zeros(len(w.hashes) + 1, U)
        np.cumsum(w.hashes * powers(_BASE, len(w.hashes)), out=sums[1:])
        total = (sums[k:] - sums[:-k]) * powers(_INVERSE, n)
    return at, mix(total[at] + U(k))


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values[first[r]:first[r + 1]] for each row (0 for empty rows)."""
    totals = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return totals[first[1:]] - totals[first[:-1]]
