"""Substring dedup: words in windows that a document with a smaller id has too are removed.

Every window of ``width`` words of every text gets a Rabin-Karp hash. A task first compares the windows of the texts it reads
together: of equal ones, all but those of the smallest document are settled on the spot, so a passage that many documents share
leaves each task once. The rest go to the range of hashes they belong to (packed, a few bytes each), where the smallest document of each
hash is found over the whole corpus and the windows of all others return to the slice of texts they came from. There the windows found merge
into maximal intervals of words, which the documents then lose.

Hashes have 64 bits; two different windows of a corpus of n windows meet with a probability of about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.llm.packs import (
    bucket_bounds, group_starts, pack, pack_ascending, text_bytes, unpack, unpack_ascending,
)
from marketframe.llm.words import hash_words, rolling, row_slices, text_buffers, window_rows

WIDTH = 13
_SLICE_BYTES = 12_000_000
_BUCKET_BYTES = 16_000_000
_SENT = "bucket int, slice long, hashes binary, windows binary, doc_ids binary, firsts binary, keys binary"
_NAMES = [c.split()[0] for c in _SENT.split(", ")]
_TYPES = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
_SPANS = "doc_id long, doc_key long, spans binary"


def _batches(rows: Iterator[tuple], at_most: int) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []
    for row in rows:
        waiting.append(row)
        if len(waiting) == at_most:
            yield _batch(waiting)
            waiting = []
    if waiting:
        yield _batch(waiting)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _runs(points: np.ndarray, width: int) -> np.ndarray:
    """Maximal intervals (start, end in turn) covered by windows that begin at ascending ``points``."""
    starts = np.flatnonzero(np.concatenate([[True], points[1:] > points[:-1] + width]))
    return np.stack([points[starts], points[np.append(starts[1:], len(points)) - 1] + width], 1).ravel()


def _least_owner(order: np.ndarray, sorted_hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The smallest owner of each run of equal hashes, in sorted order."""
    starts = group_starts(sorted_hashes)
    return np.repeat(np.minimum.reduceat(owner, starts), np.diff(np.append(starts, len(order))))


def _send(width: int, buckets: int):
    """Per slice of texts: the windows already settled, with what is known of its texts; and per range of hashes the other windows."""

    def settle(number: int, ids: np.ndarray, keys: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
        words, _, _, word_first = hash_words(data, offsets)
        row, at = window_rows(word_first, width)
        if not len(row):
            return
        hashes = rolling(words, width)[at]
        texts, first = np.unique(row, return_index=True)
        order = np.argsort(hashes)
        sorted_hashes, owner = hashes[order], ids[row[order]]
        least = _least_owner(order, sorted_hashes, owner)
        settled = np.sort(order[owner > least])
        yield (
            number % buckets, number, None, pack_ascending(settled), ids[texts].tobytes(), pack_ascending(first), keys[texts].tobytes()
        )
        mine = owner == least
        order, sorted_hashes = order[mine], sorted_hashes[mine]
        found, bounds = bucket_bounds(sorted_hashes, buckets)
        for bucket, low, high in zip(found, bounds[:-1], bounds[1:]):
            place = np.argsort(order[low:high])
            part = order[low:high][place]
            here = np.unique(np.searchsorted(first, part, "right") - 1)
            yield (
                int(bucket), number, sorted_hashes[low:high][place].tobytes(), pack_ascending(part), ids[texts[here]].tobytes(),
                pack_ascending(first[here]), None,
            )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy() for i in (0, 1))
            data, offsets = text_buffers(batch.column(2))
            for low, high in row_slices(offsets, _SLICE_BYTES):
                part = offsets[low : high + 1]
                yield from settle(number, ids[low:high], keys[low:high], data[part[0] : part[-1]], part - part[0])
                number += 1

    return lambda batches: _batches(rows(batches), 512)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows of one range of hashes: those that a smaller document has too go back to their slice."""

    def rows() -> Iterator[tuple]:
        cells, hashes, ids = [], [], []
        for row in _rows(batches):
            if row[2] is None:
                yield row
                continue
            windows, first = unpack_ascending(row[3]), unpack_ascending(row[5])
            cells.append((row[1], windows))
            hashes.append(np.frombuffer(row[2], np.uint64))
            ids.append(np.frombuffer(row[4], np.int64)[np.searchsorted(first, windows, "right") - 1])
        if not cells:
            return
        bounds = np.cumsum([0, *map(len, hashes)])
        hashes, ids = np.concatenate(hashes), np.concatenate(ids)
        order = np.argsort(hashes)
        owner = ids[order]
        again = np.zeros(len(order), bool)
        again[order[owner > _least_owner(order, hashes[order], owner)]] = True
        for (number, windows), low, high in zip(cells, bounds[:-1], bounds[1:]):
            found = windows[again[low:high]]
            if len(found):
                yield 0, number, None, pack_ascending(found), None, None, None

    return _batches(rows(), 64)


def _gather(width: int):
    """All windows found of some slices, merged into intervals by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[np.ndarray]] = {}
        texts = {}
        for _, number, _, windows, ids, firsts, keys in _rows(batches):
            found.setdefault(number, []).append(unpack_ascending(windows))
            if ids is not None:
                texts[number] = np.frombuffer(ids, np.int64), np.frombuffer(keys, np.int64), unpack_ascending(firsts)
        for number, (ids, keys, first) in texts.items():
            windows = np.sort(np.concatenate(found[number]))
            text = np.searchsorted(first, windows, "right") - 1
            starts = group_starts(text)
            ends = np.append(starts[1:], len(text))
            here = text[starts]
            spans = [pack(_runs(windows[a:b] - first[t], width)) for a, b, t in zip(starts, ends, here)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[here]), pa.array(keys[here]), pa.array(spans, pa.binary())], ["doc_id", "doc_key", "spans"]
            )

    return run


def _intervals(cells: list[bytes] | None) -> np.ndarray:
    """Disjoint intervals of word numbers, one row each. Equal rows of one id may bring the same intervals more than once."""
    return np.unique(unpack(cells[0]).reshape(-1, 2), axis=0) if cells else np.zeros((0, 2), np.int64)


def _cut(keep: int, names: list[str], as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, texts, removals = [], [], [], []
            for raw, spans in zip(*(batch.column(keep + i).to_pylist() for i in range(2))):
                raw = raw or b""
                cut = _intervals(spans)
                words = raw.split()
                counts.append(len(words))
                removed.append(int((cut[:, 1] - cut[:, 0]).sum()))
                removals.append(cut)
                if not len(cut):
                    texts.append(raw if as_text else b" ".join(words))
                elif as_text:
                    texts.append(_without(raw, cut))
                else:
                    stay = np.ones(len(words), bool)
                    for low, high in cut:
                        stay[low:high] = False
                    texts.append(b" ".join(compress(words, stay.tolist())))
            bounds = np.concatenate([[0], np.cumsum([len(c) for c in removals])]).astype(np.int32)
            flat = np.concatenate([np.zeros((0, 2), np.int64), *removals]).astype(np.int32)
            spans = pa.ListArray.from_arrays(
                pa.array(bounds), pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "end"])
            )
            kept = pa.array(texts, pa.binary()).cast(pa.string())
            counted = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), kept, spans]
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], *counted], names)

    return run


def _without(raw: bytes, cut: np.ndarray) -> bytes:
    """The text less its cut words and the white space behind each of them."""
    data = np.frombuffer(raw, np.uint8)
    _, starts, _, _ = hash_words(data, np.array([0, len(data)]))
    edges = np.append(starts, len(data))
    parts, at = [], 0
    for low, high in cut:
        parts.append(raw[at : edges[low]])
        at = int(edges[high])
    return b"".join([*parts, raw[at:]]).rstrip(b" \t\n\r\x0b\x0c")


def remove_repeats(docs: DataFrame, keep: list[str], width: int = WIDTH, as_text: bool = False) -> DataFrame:
    """``keep`` and, for every row, ``n_words``, ``n_removed``, ``kept_text`` and ``removed``.

    ``removed`` holds the maximal intervals (start, end) of word numbers cut out. ``kept_text`` is the kept words joined by one
    space or, with ``as_text``, the text as it was without the words cut. Windows are judged on the input. A null text has no words; a row
    without id neither loses words nor makes others lose them; rows that repeat an id never count as earlier than each other. Columns of
    ``docs`` outside ``keep``, ``doc_id`` and ``text`` are not read; names in ``keep`` must differ from the four results.
    """
    clash = {"n_words", "n_removed", "kept_text", "removed"} & set(keep)
    if clash:
        raise ValueError(f"these names are taken by results: {sorted(clash)}")
    buckets = max(1, -(-text_bytes(docs) // _BUCKET_BYTES))
    key = F.xxhash64("text").alias("__key")
    numbered = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), key, F.col("text").cast("binary").alias("text")
    )
    sent = numbered.mapInArrow(_send(width, buckets), _SENT).repartitionById(buckets, "bucket")
    home = F.pmod(F.xxhash64("slice"), F.lit(buckets)).cast("int")
    found = sent.mapInArrow(_compare, _SENT).repartitionById(buckets, home).mapInArrow(_gather(width), _SPANS)
    # One cell per row of the document.
    by_doc = found.groupBy(F.col("doc_id").alias("__id"), F.col("doc_key").alias("__found_key")).agg(
        F.collect_list("spans").alias("__spans")
    )
    whole = docs.select(*keep, F.col("doc_id").cast("bigint").alias("__doc"), key, F.col("text").cast("binary").alias("__text"))
    joined = whole.join(by_doc, (F.col("__doc") == F.col("__id")) & (F.col("__key") == F.col("__found_key")), "left")
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    out = T.StructType([
        *(docs.schema[k] for k in keep), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType()), T.StructField("removed", span),
    ])
    return joined.select(*keep, "__text", "__spans").mapInArrow(_cut(len(keep), out.names, as_text), out)


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cut = remove_repeats(docs, ["doc_id"])
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
