"""Words of whole texts inside a task: found, counted and hashed with numpy on Arrow buffers, no Python object per word.

A word is a run of bytes outside 0x20 and 0x09-0x0D; in UTF-8 this equals runs of code points outside that set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
_SLICE_BYTES = 2_000_000

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUE = np.random.default_rng(20240611).integers(0, 2**64 - 1, 256, dtype=np.uint64)
_LOWER_VALUE = _BYTE_VALUE.copy()
_LOWER_VALUE[65:91] = _BYTE_VALUE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the row offsets in them (a null row has no bytes)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offset_buffer, data_buffer = column.buffers()
    size = len(column) + 1
    offsets = np.frombuffer(offset_buffer, np.int64 if wide else np.int32)[column.offset : column.offset + size].astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _powers(count: int) -> np.ndarray:
    factors = np.full(max(count, 1), _BASE)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def _slice_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, ...]:
    inside = ~_SEPARATOR[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.empty(len(data), bool)
    before[:1], before[1:] = True, ~inside[:-1]
    starts = np.flatnonzero(inside & (before | cut[:-1]))
    after = np.empty(len(data), bool)
    after[-1:], after[:-1] = True, ~inside[1:]
    ends = np.flatnonzero(inside & (after | cut[1:])) + 1
    lengths = ends - starts
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends, first
    at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(at[-1] + lengths[-1]) - np.repeat(at, lengths)
    values = table[data[inside]] * _powers(int(lengths.max()))[place]
    sums = np.add.reduceat(values, at)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts, ends, first


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, ...]:
    """64-bit hash, first byte and end byte of every word, and the number of the first word of every row (one more at the end).

    ``lower`` folds A-Z. Rows are taken in slices of a few MB, so the working memory follows the slice or the longest row.
    """
    table = _LOWER_VALUE if lower else _BYTE_VALUE
    parts, firsts, row, seen = [], [], 0, 0
    while row < len(offsets) - 1:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _SLICE_BYTES, "right")) - 1)
        low, high = offsets[row], offsets[end]
        h, s, e, f = _slice_words(data[low:high], offsets[row : end + 1] - low, table)
        parts.append((h, s + low, e + low))
        firsts.append(f[:-1] + seen)
        seen += len(h)
        row = end
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
    h, s, e = (np.concatenate(x) for x in zip(*parts))
    return h, s, e, np.concatenate([*firsts, [seen]]).astype(np.int64)


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash (mod 2^64, scrambled) of every run of ``width`` consecutive values."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i in range(width):
        total = total * _BASE + hashes[i : i + count]
    return mix(total)


def window_rows(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For windows that lie inside one row: the row of each and the number of its first word."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + first[row]
    return row, at


def row_slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows of at most ``limit`` bytes, or one row."""
    row = 0
    while row < len(offsets) - 1:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end
        row = end
