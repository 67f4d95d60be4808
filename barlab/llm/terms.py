"""Alphanumeric words of whole Arrow text columns, computed on their bytes.

A word is a maximal run of ASCII letters, ASCII digits and characters beyond ASCII. Every byte of a
character beyond ASCII is at least 0x80, so UTF-8 bytes can be cut without decoding. A word is known by
the 64-bit hash of its bytes after A-Z is lowered.
"""

from __future__ import annotations

import numpy as np

from barlab.llm import texts

_PART = np.zeros(256, bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _PART[_low : _high + 1] = True


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each document the index of its first word."""
    part = _PART[data]
    first, last = part.copy(), part.copy()
    first[1:] &= ~part[:-1]
    last[:-1] &= ~part[1:]
    # Documents touch each other without a separator.
    begin = offsets[:-1][offsets[:-1] < len(data)]
    end = offsets[1:][offsets[1:] > 0] - 1
    first[begin], last[end] = part[begin], part[end]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each document the index of its first word."""
    data = texts.lowered(data)
    starts, ends, firsts = spans(data, offsets)
    return texts.word_hashes(data, starts, ends), firsts


def of_text(text: str | None) -> np.ndarray:
    """Hashes of one text's words, in order."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return hashed(data, np.array([0, len(data)]))[0]


def lookup(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of hashes in a sorted vocabulary, -1 where absent."""
    if not len(vocabulary):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, -1)
