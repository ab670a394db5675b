"""Words of many texts at once, as numpy arrays: hashes without a Python loop over words.

A word's hash is a polynomial in its bytes over 2**64, taken from prefix sums; texts are
handled in pieces of about 256 KB that end at a separator, so memory does not follow
the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from millrace.llm import worker

U = np.uint64
SEGMENT = 1 << 18
_BASE = 0x9E3779B97F4A7C13  # 3 modulo 8, so that powers differ in low bits


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 (Steele et al., OOPSLA 2014)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]

#: Space and tab to carriage return.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but letters and digits.
PUNCT = np.zeros(256, dtype=bool)
PUNCT[:0x80] = True
PUNCT[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False

_powers: list[np.ndarray] = []
worker.KEPT.append(_powers)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base, and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, SEGMENT + 4096)
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(n, base, dtype=np.uint64)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        if n > 4 * SEGMENT:
            return out[0], out[1]
        _powers[:] = out
    return _powers[0], _powers[1]


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)), offsets


def _segment(data: np.ndarray, cuts: np.ndarray, sep: np.ndarray, places: bool) -> tuple[np.ndarray, ...]:
    """Hashes, starts and ends of the words of data; cuts: offsets at which a word also ends."""
    gap = sep[data]
    word = ~gap
    first, last = word.copy(), word.copy()
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[cuts] = True
    first[1:] &= gap[:-1] | edge[1:-1]
    last[:-1] &= gap[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_LOWER[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]), starts, ends


def _pieces(data: np.ndarray, lo: int, hi: int, sep: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut a long text at separators."""
    while hi - lo > SEGMENT:
        at = lo + SEGMENT
        while True:
            found = np.flatnonzero(sep[data[at : min(hi, at + 65536)]])
            if len(found):
                at += int(found[0])
                break
            at += 65536
            if at >= hi:
                at = hi
                break
        yield lo, at
        lo = at
    if lo < hi:
        yield lo, hi


def words(column: pa.Array, sep: np.ndarray, places: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, hashes, row offsets into them, starts, ends) for groups of consecutive rows.

    Words are the longest runs of bytes outside ``sep``, with A-Z as a-z.  Starts and ends are
    byte offsets within the row's text.
    """
    data, offsets = string_buffers(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + SEGMENT, side="right")) - 1
        if end <= row:  # one long text
            parts = [(_segment(data[a:b], np.zeros(0, np.int64), sep, places), a - offsets[row]) for a, b in _pieces(data, int(offsets[row]), int(offsets[row + 1]), sep)]
            hashes = np.concatenate([p[0][0] for p in parts])
            starts = np.concatenate([p[0][1] + p[1] for p in parts])
            ends = np.concatenate([p[0][2] + p[1] for p in parts])
            yield row, hashes, np.array([0, len(hashes)]), starts, ends
            row += 1
            continue
        end = min(end, n)
        base = offsets[row]
        cuts = offsets[row : end + 1] - base
        hashes, starts, ends = _segment(data[base : offsets[end]], cuts, sep, places) if offsets[end] > base else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        at = np.searchsorted(starts, cuts)
        if places:
            shift = np.repeat(cuts[:-1], np.diff(at))
            starts, ends = starts - shift, ends - shift
        yield row, hashes, at, starts, ends
        row = end


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of width words; of a shorter sequence, the whole as one; of none, none."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(width, n)
    out = hashes[: n - k + 1] * U(2 * k + 1)
    for j in range(1, k):
        out = mix(out) + hashes[j : n - k + 1 + j] * U(0xD6E8FEB86659FD93)
    return mix(out)
