"""Vectorised words of Arrow text batches: ASCII lower-casing, word spans and 64-bit word hashes, a bounded slice at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21  # text handled at once; a longer text is a slice of its own
SMALL_BYTES = 1 << 19  # the same where a task holds much besides: Words needs some forty bytes for each of the text

_U64 = np.uint64
_BASE = _U64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = _U64(pow(int(_BASE), -1, 1 << 64))
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * _U64(2) + _U64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
# Everything in ASCII that is neither a digit nor a letter once A-Z are lower-cased.
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[:48] = NON_ALNUM[58:97] = NON_ALNUM[123:128] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of slices of at most `limit` bytes, or one row. Null is empty."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    a = a.cast(pa.large_string()).fill_null("")
    n = len(a)
    if not n:
        return
    offsets = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset : a.offset + n + 1]
    data = np.frombuffer(a.buffers()[2], dtype=np.uint8) if a.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


class Words:
    """Words of one slice: `start`, `end` (bytes in the slice), `hash`, and `first[i]`, the index of row i's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
        text = _LOWER[data]
        sep = separators[text]
        edge = np.zeros(len(text) + 1, bool)
        edge[offsets] = True  # a text never continues the word before it
        word = ~sep
        begins = word.copy()
        begins[1:] &= sep[:-1] | edge[1:-1]
        ends = word
        ends[:-1] &= sep[1:] | edge[1:-1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        n = len(text)
        powers = np.full(n, _BASE, np.uint64)
        powers[:1] = 1
        np.cumprod(powers, out=powers)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[text] * powers, out=sums[1:])
        back = np.full(n, _BASE_INV, np.uint64)
        back[:1] = 1
        np.cumprod(back, out=back)
        self.hash = mix((sums[self.end] - sums[self.start]) * back[self.start] + (self.end - self.start).astype(np.uint64))


def hash_words(words: list[bytes]) -> np.ndarray:
    """The same hashes for given words (already lower-cased, without separators)."""
    joined = b"".join(words)
    offsets = np.cumsum([0, *map(len, words)])
    return Words(np.frombuffer(joined, np.uint8), offsets, np.zeros(256, bool)).hash


_ROW = mix(np.arange(1, 65, dtype=np.uint64) * _U64(0x632BE59BD9B4E019)) | _U64(1)


def shingles(words: Words, i: int, k: int) -> np.ndarray:
    """Sorted distinct hashes of row i's k-word shingles; with fewer words the whole sequence is one; none without words."""
    h = words.hash[words.first[i] : words.first[i + 1]]
    if not len(h):
        return h
    w = min(k, len(h))
    n = len(h) - w + 1
    s = np.full(n, w, np.uint64)
    for j in range(w):
        s += h[j : j + n] * _ROW[j]
    return np.unique(mix(s))
