"""Numpy helpers that work inside tasks on the bytes of an Arrow text column.

Words are maximal runs of bytes that are not ASCII white space (0x20, 0x09-0x0D). A word is
represented by a 64-bit hash of its bytes: a polynomial modulo 2**64 over random byte values,
read off a running sum and then mixed. All helpers take a whole batch at once; long texts are
handled in blocks, so memory follows the batch and not the longest text.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_values = np.random.Generator(np.random.PCG64(20240611)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_lower = _values.copy()
_lower[65:91] = _values[97:123]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _ODD, np.uint64)
    down = np.full(size, np.uint64(pow(int(_ODD), -1, 2**64)), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, offsets of the rows in it, first byte of every word, byte after it)."""
    values = _lower if lower else _values
    hashes, starts, ends = [], [], []
    total, at = len(data), 0
    while at < total:
        stop = min(total, at + BLOCK)
        while stop < total:  # move to the next white space or start of a row
            row = offsets[np.searchsorted(offsets, stop)]
            gap = np.flatnonzero(SPACE[data[stop : min(row, stop + 4096)]])
            if len(gap) or row <= stop + 4096:
                stop = stop + int(gap[0]) if len(gap) else int(row)
                break
            stop += 4096
        block = data[at:stop]
        size = len(block)
        up, down = _powers(max(2 * BLOCK, 1 << size.bit_length()))
        space = SPACE[block]
        fresh = np.empty(size + 1, bool)
        fresh[0] = fresh[size] = True
        fresh[1:size] = space[:-1]
        rows = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, stop)] - at
        first = fresh[:-1].copy()
        first[rows] = True
        last = np.empty(size, bool)
        last[:-1] = space[1:]
        last[-1] = True
        last[rows[rows > 0] - 1] = True
        begin = np.flatnonzero(first & ~space)
        end = np.flatnonzero(last & ~space) + 1
        run = np.zeros(size + 1, np.uint64)
        np.cumsum(values[block] * up[:size], out=run[1:])
        hashes.append(mix((run[end] - run[begin]) * down[begin]))
        starts.append(begin + at)
        ends.append(end + at)
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, ends = np.concatenate(starts), np.concatenate(ends)
    return np.concatenate(hashes), np.searchsorted(starts, offsets).astype(np.int64), starts, ends


def shingles(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of `size` words within a row, offsets of the rows in it)."""
    counts = np.maximum(np.diff(offsets) - size + 1, 0)
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    total = max(len(words) - size + 1, 0)
    runs = np.zeros(total, np.uint64)
    for k in range(size):
        runs = runs * np.uint64(0xD1342543DE82EF95) + words[k : k + total]
    keep = np.zeros(total, bool)
    begin, end = offsets[:-1][counts > 0], (offsets[1:] - size + 1)[counts > 0]
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, end, -1)
    keep = np.cumsum(edge[:-1]) > 0
    return mix(runs[keep] + np.uint64(size)), out


def shingle_sets(words: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingles of every row; a row of fewer words has its whole sequence as one."""
    runs, at = shingles(words, offsets, size)
    sets = []
    for i in range(len(offsets) - 1):
        own = runs[at[i] : at[i + 1]]
        count = offsets[i + 1] - offsets[i]
        if 0 < count < size:
            own = shingles(words[offsets[i] : offsets[i + 1]], np.array([0, count]), int(count))[0]
        sets.append(np.unique(own))
    return sets
