"""Words and word shingles of many texts at once, as numpy arrays over the Arrow bytes.

A word is a run of bytes other than space and tab..carriage return, after lower-casing A-Z; this equals the
pattern ``[^\\x20\\x09-\\x0D]+`` on characters, because those bytes never occur inside a UTF-8 sequence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import slices, text_buffers

_BASE = np.uint64(0x9E3779B97F4A7C55)
_MULT = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                  0xE7037ED1A0B428DB], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: True for the bytes that end a word: white space; or every ASCII sign but letters, digits and the underscore.
SPACES = np.isin(np.arange(256), [32, *range(9, 14)])
SIGNS = np.array([b < 128 and not (chr(b).isalnum() or b == 95) for b in range(256)])


def word_hashes(raw: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACES,
                latin: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and n + 1 offsets of each text into them.

    A-Z are lower-cased, and with ``latin`` also the capitals from U+00C0 to U+00DE (second bytes after 0xC3).
    """
    n = len(offsets) - 1
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    upper = (raw >= 65) & (raw <= 90)
    low = raw + (upper.astype(np.uint8) << 5)
    if latin:
        second = raw[1:]
        low[1:] += ((raw[:-1] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)).astype(np.uint8) << 5
    inside = ~breaks[raw]
    first = np.zeros(len(raw), bool)
    first[offsets[:-1][offsets[:-1] < len(raw)]] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    lengths = np.diff(np.append(starts, len(raw)))
    place = np.arange(len(raw), dtype=np.int64)
    place[starts[0]:] -= np.repeat(starts, lengths)
    place[:starts[0]] = 0
    powers = _powers(int(max(lengths.max(), 1)) + 1)
    terms = (low.astype(np.uint64) + np.uint64(1)) * powers[place]
    terms[~inside] = 0
    sums = np.add.reduceat(terms, starts)
    return mix(sums), np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """The distinct ``size``-word shingles of one text's word hashes, sorted; the whole text if it has fewer words."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    span = min(n, size)
    total = np.full(n - span + 1, span, np.uint64)
    for k in range(span):
        total += words[k:n - span + 1 + k] * _MULT[k % len(_MULT)] * np.uint64(2 * (k // len(_MULT)) + 1)
    return np.unique(mix(total))


def shingle_sets(column: pa.StringArray, size: int = 5):
    """For each text in turn its sorted distinct shingles; null and wordless texts give an empty array."""
    for start, stop in slices(column):
        raw, off = text_buffers(column.slice(start, stop - start))
        words, at = word_hashes(raw, off)
        for i in range(stop - start):
            yield shingles(words[at[i]:at[i + 1]], size)
