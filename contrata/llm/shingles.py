"""Word shingles of whole texts as 64-bit hashes, for a batch of texts at once.

Words are runs of bytes other than space and 0x09-0x0D after A-Z are lower-cased; a shingle is `width`
consecutive words, and a text with fewer words is one shingle of them all. No Python object is made per word:
a word's hash is a difference of prefix sums of a polynomial over the batch's bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WIDTH = 5
#: Bytes hashed at a time, so that temporary arrays stay small; one longer text makes a larger piece.
PIECE = 1 << 18

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + 1024)
        _powers[:] = []
        for base in (_P, _P_INVERSE):
            x = np.full(size, base)
            x[0] = 1
            _powers.append(np.cumprod(x, dtype=np.uint64))
    return _powers[0][:n], _powers[1][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the offsets of its texts; a null has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data, offsets


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and for each text the place of its first word (with one more entry at the end)."""
    low, high = int(offsets[0]), int(offsets[-1])
    at = offsets - low
    n = high - low
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    raw = _LOWER[data[low:high]]
    inside = ~_SPACE[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[at] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    power, inverse = _power(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, at).astype(np.int64)


def _combined(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(first)
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    place = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(int(place[-1]), dtype=np.uint64)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * _P) | np.uint64(1)
    long = counts >= width
    if long.any():
        source = np.repeat(first[:-1][long] - place[:-1][long], n[long])
        target = np.flatnonzero(np.repeat(long, n))
        source = source + target
        total = np.zeros(len(target), dtype=np.uint64)
        for j in range(width):
            total += words[source + j] * factors[j]
        out[target] = mix(total)
    for i in np.flatnonzero((counts > 0) & ~long):
        own = words[first[i] : first[i + 1]]
        out[place[i]] = mix(np.array([(own * factors[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))], dtype=np.uint64) ^ _P)[0]
    return out, place


def shingles(column: pa.Array, width: int = WIDTH):
    """Yields, for consecutive runs of the column's texts: the run's first index, the hashes of all its shingles in order of the texts (with repeats), and each text's first place among them."""
    data, offsets = utf8(column)
    i = 0
    while i + 1 < len(offsets):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, side="right")) - 1)
        words, first = word_hashes(data, offsets[i : j + 1])
        values, place = _combined(words, first, width)
        yield i, values, place
        i = j


def shingle_sets(column: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    out = []
    for _, values, place in shingles(column, width):
        out += [np.unique(values[place[k] : place[k + 1]]) for k in range(len(place) - 1)]
    return out
