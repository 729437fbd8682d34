"""Words, lines and their hashes over the raw UTF-8 bytes of Arrow string columns, with numpy.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D; as these are ASCII, cutting bytes is
cutting characters.  Hashes are 64-bit polynomials over a fixed random table, with a final mix; they depend
on nothing but the bytes, so that all executors agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
#: Bytes hashed at once; bounds the tables of powers.
SLICE = 1 << 18

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER_TABLE = _TABLE[LOWER]
_powers: tuple[np.ndarray, np.ndarray] | None = None


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit numbers."""
    x = x.astype(U64, copy=True)
    x += U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column, wide = column.cast(pa.large_string()), True
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(column: pa.Array | pa.ChunkedArray, most: int = 1 << 23) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about `most` bytes: first row, end row, bytes, offsets.  A longer text stands alone."""
    data, offs = buffers(column)
    row, end = 0, len(offs) - 1
    while row < end:
        stop = max(row + 1, int(np.searchsorted(offs, offs[row] + most, "right")) - 1)
        yield row, stop, data[offs[row] : offs[stop]], offs[row : stop + 1] - offs[row]
        row = stop


def spans(keep: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of kept bytes, none across texts, and each text's first run."""
    n = len(keep)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    edge = offs[:-1][offs[:-1] < n]
    first = keep.copy()
    first[1:] &= ~keep[:-1]
    first[edge] = keep[edge]
    last = keep.copy()
    last[:-1] &= ~keep[1:]
    before = edge[edge > 0] - 1
    last[before] = keep[before]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the index of each text's first word (one more than texts)."""
    return spans(~SPACE[data], offs)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, SLICE + 1)
        up, down = np.full(size, _BASE, U64), np.full(size, _INVERSE, U64)
        up[0] = down[0] = 1
        _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each of the byte runs, which are in ascending order and don't overlap."""
    table, out, at, n = _LOWER_TABLE if lower else _TABLE, np.empty(len(starts), U64), 0, len(starts)
    while at < n:
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE, "right")))
        low, high = int(starts[at]), int(ends[stop - 1])
        up, down = _power_tables(high - low + 1)
        total = np.zeros(high - low + 1, U64)
        np.cumsum(table[data[low:high]] * up[: high - low], out=total[1:])
        a, b = starts[at:stop] - low, ends[at:stop] - low
        out[at:stop] = (total[b] - total[a]) * down[a] + (b - a).astype(U64)
        at = stop
    return mix(out)


def windows(hashed: np.ndarray, first: np.ndarray, width: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words of each text, and each text's first.

    whole: a text with fewer words has all its words as the one run; else it has none.
    """
    counts = np.diff(first)
    runs = np.maximum(counts - width + 1, (counts > 0).astype(counts.dtype) if whole else 0)
    begin = np.zeros(len(first), np.int64)
    np.cumsum(runs, out=begin[1:])
    total = int(begin[-1])
    if not total:
        return np.zeros(0, U64), begin
    at = np.arange(total) - np.repeat(begin[:-1] - first[:-1], runs)
    left = np.repeat(first[1:], runs) - at
    out = np.zeros(total, U64)
    padded = np.concatenate([hashed, np.zeros(width, U64)])
    for k in range(width):
        out *= U64(0xD6E8FEB86659FD93)
        out += np.where(left > k, padded[at + k], U64(0)) if whole else padded[at + k]
    return mix(out), begin


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether another element has the same key."""
    order = np.argsort(keys)
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    out = np.empty(len(keys), bool)
    out[order] = same[1:] | same[:-1]
    return out


def per_text(keys: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Keys told apart by text."""
    return keys ^ mix(np.repeat(np.arange(len(begin) - 1).astype(U64), np.diff(begin)))
