"""Numpy kernels over the UTF-8 bytes of an Arrow batch.

Words are the runs of bytes outside ``[\\x20\\x09-\\x0D]``; those bytes occur in UTF-8 as
themselves only.  Hashes have 64 bits and are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Bytes hashed at a time; small enough for the arrays over them to stay in cache.
_CHUNK = 1 << 18


def utf8(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string array and the offsets between them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return (_LOWER[raw] if lower else raw), offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and at which word each text starts (one more at the end).

    ``space`` says of each byte whether it is between words.
    """
    inside = ~space[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over the whole word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, space: np.ndarray = _SPACE, base: np.uint64 = _BASE) -> np.ndarray:
    """Hash of each word by its bytes; ``base`` is an odd number."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(starts, starts[i] + _CHUNK)), i + 1)
        at, n = starts[i:j] - starts[i], int(ends[j - 1] - starts[i])
        raw = data[starts[i] : ends[j - 1]]
        longest = int((ends[i:j] - starts[i:j]).max())
        place = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
        value = (raw.astype(np.uint64) + np.uint64(1)) * _powers(base, longest + 1)[np.minimum(place, longest)]
        value[space[raw]] = 0
        out[i:j] = np.add.reduceat(value, at)
        i = j
    return mixed(out)


@np.errstate(over="ignore")
def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` items; windows are built up by doubling."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    done, total, power, size, factor = 0, None, hashes, 1, _STEP
    while True:
        if width & size:
            total = power[:n] if total is None else total * factor + power[done : done + n]
            done += size
        if size * 2 > width:
            return mixed(total)
        power = power[:-size] * factor + power[size:]
        factor, size = factor * factor, size * 2


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of ``limit`` items together at most, or of a single text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1, i + 1)
        yield i, j
        i = j


def shingles(column: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of ``width`` words, A-Z in lower case.

    A text of fewer words has its whole sequence as the only one, a text without words none.
    """
    data, offsets = utf8(column, lower=True)
    starts, ends, first = spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    windows = window_hashes(hashes, width)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            own = np.sort(windows[a : b - width + 1])
            fresh = np.empty(len(own), dtype=bool)
            fresh[0] = True
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            out.append(own[fresh])
        elif b > a:
            out.append(mixed(window_hashes(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
