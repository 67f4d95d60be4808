"""Words and shingles of whole Arrow text columns, computed on their bytes.

A word is ``[^\\x20\\x09-\\x0D]+``. All separators are single ASCII bytes, so UTF-8 bytes can be
cut without decoding, and the words of many documents are found and hashed by a handful of
NumPy passes. Slices are bounded by bytes; only one document longer than the bound exceeds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_PLACE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
        if size > 64 * SLICE_BYTES:  # do not keep tables made for one huge document
            tables = tuple(_powers)
            _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
            return tables
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * _MIX[0]
    h = h ^ (h >> np.uint64(27))
    h = h * _MIX[1]
    return h ^ (h >> np.uint64(31))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows of a text column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each document the index of its first word."""
    word = ~_SEPARATOR[data]
    before = np.empty(len(word) + 1, bool)
    before[0] = False
    before[1:] = word
    after = np.append(word, False)
    before[offsets] = False  # documents touch each other without a separator
    inside = after.copy()
    inside[offsets] = False
    starts = np.flatnonzero(after[:-1] & ~before[:-1])
    ends = np.flatnonzero(word & ~inside[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges: a polynomial modulo 2^64, then mixed."""
    powers, inverses = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts])


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def shingle_hashes(
    data: np.ndarray, offsets: np.ndarray, n: int = 3
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and byte lengths of the n-word shingles, and each document's first one.

    A document with fewer than n words, but one at least, has its whole sequence as one shingle.
    """
    starts, ends, firsts = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    counts = np.diff(firsts)
    made = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(made)))
    doc = np.repeat(np.arange(len(made)), made)
    at = firsts[:-1][doc] + np.arange(bounds[-1]) - bounds[:-1][doc]
    total = np.zeros(len(at), np.uint64)
    for k in range(n):
        there = k < counts[doc]
        total += np.where(there, words[np.minimum(at + k, max(len(words) - 1, 0))] * _PLACE[k % 3], 0)
        total = mix(total + np.uint64(k + 1))
    last = at + np.minimum(counts[doc], n) - 1
    return mix(total), ends[last] - starts[at], bounds
