"""Hashes over bytes and words of many texts at once, and winnowing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: An odd factor and its inverse modulo 2**64: powers of it weigh the bytes of a string.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)

_powers: dict[int, np.ndarray] = {}


def powers(factor: int, n: int) -> np.ndarray:
    """factor ** 0 .. factor ** (n - 1) modulo 2**64; kept, and made longer by doubling."""
    known = _powers.get(factor)
    if known is None or len(known) < n:
        size = 1 << max(16, (n - 1).bit_length())
        every = np.full(size, factor, np.uint64)
        every[0] = 1
        known = np.cumprod(every)
        if size <= 1 << 22:
            _powers[factor] = known
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running weighted sums of bytes; ``span_hashes`` reads any span's hash from them."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(FACTOR, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (sums[end] - sums[first]) * powers(INVERSE, len(sums))[first]


#: Bytes that part words.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


#: Bytes whose running sums are held at once.
_PIECE = 1 << 22


def _word_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of each word, for words of some megabytes at a time; a longer one alone."""
    found = np.empty(len(first), np.uint64)
    start = 0
    while start < len(first):
        stop = max(start + 1, int(np.searchsorted(end, first[start] + _PIECE, side="right")))
        low = first[start]
        sums = prefix_hashes(data[low : end[stop - 1]])
        found[start:stop] = span_hashes(sums, first[start:stop] - low, end[start:stop] - low)
        start = stop
    return mixed(found ^ ((end - first).astype(np.uint64) << np.uint64(40)))


def words(data: np.ndarray, starts: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts that lie in a row in ``data``: first byte, end, hash, and for each
    text the number of words before it (and of all at the end)."""
    inside = ~apart[data]
    head = np.zeros(len(data), bool)
    head[starts[:-1][starts[:-1] < len(data)]] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | head[1:]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | head[1:]
    first, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return first, end, _word_hashes(data, first, end), np.searchsorted(first, starts)


def joined_words(data: np.ndarray, first: np.ndarray, end: np.ndarray, kept: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space, in UTF-8."""
    first, end = first[kept], end[kept]
    size = end - first
    before = np.r_[0, np.cumsum(kept)][counts]
    # Every word and a space after it; the last space of a text is left out.
    after = np.cumsum(size + 1)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[first] = 1
    inside[end] -= 1
    bytes_at = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    last = np.zeros(len(first) + 1, bool)
    last[before[1:][np.diff(before) > 0] - 1] = True
    to = after - size - 1 - np.r_[0, np.cumsum(last[:-1])][:-1]
    texts = np.r_[0, after][before] - np.r_[0, np.cumsum(np.diff(before) > 0)]
    out = np.full(int(texts[-1]), 0x20, np.uint8)
    out[bytes_at + np.repeat(to - first, size)] = data[bytes_at]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts) - 1, [None, pa.py_buffer(texts), pa.py_buffer(out)])


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each ``n`` neighbouring word hashes."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    found = hashes[: len(hashes) - n + 1]
    for i in range(1, n):
        found = mixed(found * np.uint64(FACTOR) + hashes[i : len(hashes) - n + 1 + i])
    return found


#: Low bits of an order value that hold the place.
PLACE_BITS = 24


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """For each ``width`` neighbours the place of the lowest value, the first one of equals.

    Values are compared by their high bits, so equal neighbours choose alike anywhere.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    if len(values) > 1 << PLACE_BITS:
        half = len(values) // 2
        left = lowest(values[: half + width - 1], width)
        return np.concatenate([left, lowest(values[len(left) :], width) + len(left)])[:n]
    low = np.uint64((1 << PLACE_BITS) - 1)
    order = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        order = np.minimum(order[:-span], order[span:])
        span *= 2
    order = np.minimum(order[:n], order[width - span : width - span + n])
    return (order & low).astype(np.int64)


def windows(counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all windows of ``width`` items that lie in one text, and the text of each;
    ``counts`` has the number of items before each text."""
    sizes = np.maximum(0, np.diff(counts) - width + 1)
    text = np.repeat(np.arange(len(sizes)), sizes)
    before = np.cumsum(sizes) - sizes
    return counts[text] + np.arange(len(text)) - before[text], text
