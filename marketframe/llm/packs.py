"""Many small values for one task, packed as arrays into one binary cell, so that Spark shuffles a few large rows instead of many small ones."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts."""
    total = F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))
    return int(docs.agg(total).first()[0])


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash; buckets are equal ranges of hashes, so sorted hashes have ascending buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def bucket_bounds(sorted_hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets present among sorted hashes, and where each begins (one more at the end)."""
    found, begins = np.unique(bucket_of(sorted_hashes, buckets), return_index=True)
    return found.astype(np.int64), np.append(begins, len(sorted_hashes))


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on in the narrowest of 1, 2, 4 or 8 bytes, behind one byte that names the width.

    All first bytes come first, then all second ones: the higher ones are mostly zero, and Spark's compression takes them out.
    """
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if w == 8 or top < 1 << 8 * w)
    cells = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    return bytes([width]) + cells.T.tobytes()


def unpack(cell: bytes) -> np.ndarray:
    width = cell[0]
    planes = np.frombuffer(cell, np.uint8, offset=1).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def press(values: np.ndarray) -> bytes:
    """The same as ``pack``, with each plane of bytes compressed by itself where that makes it smaller."""
    cell, count = pack(values), len(values)
    planes = [cell[1 + i * count : 1 + (i + 1) * count] for i in range(cell[0])]
    if count > 64:
        planes = [min(plane, pa.compress(plane, codec="zstd", asbytes=True), key=len) for plane in planes]
    return struct.pack(f"<BI{len(planes)}I", len(planes), count, *map(len, planes)) + b"".join(planes)


def unpress(cell: bytes) -> np.ndarray:
    width, count = struct.unpack_from("<BI", cell)
    planes, at = [], 5 + 4 * width
    for size in struct.unpack_from(f"<{width}I", cell, 5):
        plane = cell[at : at + size]
        planes.append(plane if size == count else pa.decompress(plane, decompressed_size=count, codec="zstd", asbytes=True))
        at += size
    return unpack(b"".join([bytes([width]), *planes]))


def pack_ascending(values: np.ndarray) -> bytes:
    """Ascending whole numbers, by their differences."""
    return pack(np.diff(values, prepend=0)) if len(values) else pack(values)


def unpack_ascending(cell: bytes) -> np.ndarray:
    return np.cumsum(unpack(cell))


def group_starts(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
