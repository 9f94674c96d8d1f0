"""Token files: equal-length sequences and masks as fixed-size-list batches in Arrow's stream-based file format.

Documents are range partitioned by id; each task encodes its documents in ascending order and writes two files: ``*.tokens.arrow``
with one row per sequence (``tokens`` fixed_size_list<uint16>, or uint32 for vocabularies of more than 65,536 ids; ``mask``
fixed_size_list<bool>: true for a token, false for padding at the end of the file) and ``*.docs.arrow`` with the place of each document. As every row has the same length and every batch but the last the
same number of rows, any sequence is found by arithmetic and read without copying from a memory map.

A task names its files anew at each attempt and reports them in a manifest that Spark commits, so files of lost or repeated
attempts are never read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketframe.llm.bpe import TextEncoder, load, vocabulary_path
from marketframe.session import scratch_path

_MANIFEST = "part int, roll int, n_docs long, n_tokens long, tokens_file string, docs_file string"
_ROWS = 64
_FILE_TOKENS = 1 << 28
_REMEMBERED = 1_500_000
_MARKS = ".,;:!?"
_LAST_LETTER = "\u024f"  # later letters may be newer than the library's tables
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class LibraryEncoder(TextEncoder):
    """Ids by the tokenizers library. Chunks not seen before are taken apart into words, and words not seen before are encoded in one call.

    A chunk holds no space and gets one before it, so in the ids of the joined text each id whose bytes begin with a space begins
    a chunk. A mark behind a word and a line end are pieces of their own, so words with them need no call of their own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already fill the cores
        from tokenizers import Tokenizer

        library, tables = Tokenizer.from_file(path), load(path)
        library.no_padding()
        library.no_truncation()
        self.library, self.largest = library, len(tables.offsets) - 2
        self.spaced = np.zeros(len(tables.offsets), bool)
        self.spaced[[int(i) for i, b in zip(tables.ids, tables.bytes) if b.startswith(b" ")]] = True
        self.marks = {m: self.ids(m).tobytes() for m in _MARKS}
        self.line_end, self.bare = self.ids("\n"), {}
        super().__init__(lambda piece: self.ids(piece).tobytes(), tables.special, tables.specials)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn_words(self, words: list[str], memory: dict[str, bytes], between: str) -> None:
        """Ids of words, each behind ``between`` (a space belongs to the word, a line end does not)."""
        for low in range(0, len(words), 50_000):
            part = words[low : low + 50_000]
            ids = self.ids(between + between.join(part))
            raw = ids.tobytes()
            begins = np.flatnonzero(self.spaced[ids] if between == " " else ids == self.line_end[0]) * 4
            skip = 0 if between == " " else 4
            memory.update((c, raw[a + skip : b]) for c, a, b in zip(part, begins.tolist(), [*begins[1:].tolist(), len(raw)], strict=True))

    def _learn(self, chunks: set[str]) -> None:
        """Ids of chunks that neither are empty nor begin or end with white space."""
        marks, whole, marked, parted, words, lines = self.marks, [], [], [], set(), set()
        for chunk in chunks:
            if chunk.isalpha():
                whole.append(chunk)
            elif "\n" not in chunk:
                word = chunk[:-1]
                if chunk[-1] in marks and word.isalpha() and word[-1] <= _LAST_LETTER:
                    marked.append((chunk, word))
                    words.add(word)
                else:
                    whole.append(chunk)
            else:
                parts = [(line[:-1], marks[line[-1]]) if line[-1:] in marks else (line, b"") for line in chunk.split("\n")]
                if all(word.isalpha() and word[-1] <= _LAST_LETTER for word, _ in parts):
                    parted.append((chunk, parts))
                    words.add(parts[0][0])
                    lines.update([word for word, _ in parts[1:]])
                else:
                    whole.append(chunk)
        rest, bare, end = self.rest, self.bare, self.line_end.tobytes()
        whole += [w for w in words if w not in rest and w not in chunks]
        self._learn_words(whole, rest, " ")
        self._learn_words([w for w in lines if w not in bare], bare, "\n")
        for chunk, word in marked:
            rest[chunk] = rest[word] + marks[chunk[-1]]
        for chunk, ((word, mark), *more) in parted:
            rest[chunk] = rest[word] + mark + b"".join([end + bare[w] + m for w, m in more])

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text. A text with a special token, or with other white space beside a space, is encoded by itself."""
        get, found, waiting, new = self.rest.get, [b""] * len(texts), [], set()
        specials, first = list(self.specials) if self.special is not None else [], self.first
        for row, text in enumerate(texts):
            if not text:
                continue
            alone = False
            for s in specials:
                alone |= s in text
            head, *tail = text.split(" ")
            if alone or not head or head[0].isspace() or head[-1].isspace():
                found[row] = self.ids(text).tobytes()
                continue
            ids = list(map(get, tail))
            if None in ids:
                gaps = [(k, tail[k]) for k, i in enumerate(ids) if i is None]
                new.update([chunk for _, chunk in gaps])
                waiting.append((row, text, head, ids, gaps))
            else:
                found[row] = first[head] + b"".join(ids)
        # What is remembered neither is empty nor has white space at an end, so any such chunk is among the new ones.
        odd = {c for c in new if not c or c[0].isspace() or c[-1].isspace()}
        self._learn(new - odd)
        rest = self.rest
        for row, text, head, ids, gaps in waiting:
            if odd and any(chunk in odd for _, chunk in gaps):
                found[row] = self.ids(text).tobytes()
                continue
            for k, chunk in gaps:
                ids[k] = rest[chunk]
            found[row] = first[head] + b"".join(ids)
        if len(self.rest) + len(self.first) + len(self.memory) + len(self.bare) > _REMEMBERED:
            # Words met early are the frequent ones: they stay.
            kept = list(islice(self.rest.items(), _REMEMBERED // 3)), list(islice(self.bare.items(), _REMEMBERED // 15))
            for memory in (self.rest, self.first, self.memory, self.bare):
                memory.clear()
            self.rest.update(kept[0])
            self.bare.update(kept[1])
        return found


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def _open(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path)


class _Writer:
    """One pair of files."""

    def __init__(self, folder: str, length: int, width: type[np.unsignedinteger]):
        self.length, self.width, self.left, self.place, self.docs = length, width, [], 0, []
        self.waiting = 0
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        name = uuid.uuid4().hex
        self.tokens_file, self.docs_file = f"{folder}/{name}.tokens.arrow", f"{folder}/{name}.docs.arrow"
        self.system, self.docs_path = system, f"{base}/{name}.docs.arrow"
        self.schema = pa.schema([("tokens", pa.list_(pa.from_numpy_dtype(width), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.stream = system.open_output_stream(f"{base}/{name}.tokens.arrow")
        self.file = pa.ipc.new_file(self.stream, self.schema)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        count = len(ids) // 4
        self.docs.append((doc_id, self.place, count))
        self.place += count
        self.left.append(ids)
        self.waiting += count
        if self.waiting >= self.length * _ROWS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        values = np.frombuffer(b"".join(self.left), np.uint32)
        step = self.length * _ROWS
        whole = len(values) // step * step
        for low in range(0, whole, step):
            self._batch(values[low : low + step], step)
        rest = values[whole:]
        if last and len(rest):
            rows = -(-len(rest) // self.length)
            self._batch(np.concatenate([rest, np.zeros(rows * self.length - len(rest), np.uint32)]), len(rest))
            rest = rest[:0]
        self.left, self.waiting = [rest.tobytes()], len(rest)

    def _batch(self, values: np.ndarray, real: int) -> None:
        columns = values.astype(self.width), np.arange(len(values)) < real
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.length) for v in columns]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> tuple[int, int, str, str]:
        self._flush(True)
        self.file.close()
        self.stream.close()
        with self.system.open_output_stream(self.docs_path) as out, pa.ipc.new_file(out, _DOCS) as file:
            columns = zip(*self.docs) if self.docs else ([], [], [])
            file.write_batch(pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], schema=_DOCS))
        return len(self.docs), self.place, self.tokens_file, self.docs_file


def write_tokens(docs: DataFrame, vocabulary: str, folder: str, length: int = 2048, end_id: int = 0) -> DataFrame:
    """Write the ids of every whole text, each followed by ``end_id``, and return the manifest, one row per file.

    A null text is empty, so it gives the end id alone. Documents ascend by id, null ids first; equal ids by text. An empty
    table gives no files. Further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = library_encoder(vocabulary), np.uint32(end_id).tobytes()
        width = np.uint16 if max(encoder.largest, end_id) < 1 << 16 else np.uint32
        part, roll, writer, closed = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            texts = batch.column(1).to_pylist()
            numbers = batch.column(0).to_pylist()
            for low in range(0, len(texts), 2000):
                for doc_id, ids in zip(numbers[low : low + 2000], encoder.encode_all(texts[low : low + 2000])):
                    if writer is None:
                        writer = _Writer(folder, length, width)
                    writer.add(doc_id, ids + end)
                    if writer.place >= _FILE_TOKENS:
                        closed.append((part, roll, *writer.close()))
                        writer, roll = None, roll + 1
        if writer is not None:
            closed.append((part, roll, *writer.close()))
        if closed:
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = ["part", "roll", "n_docs", "n_tokens", "tokens_file", "docs_file"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*closed), types)], names)

    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    manifest = f"{folder}/manifest"
    ordered.mapInArrow(run, _MANIFEST).write.parquet(manifest)
    return docs.sparkSession.read.parquet(manifest)


class TokenFile:
    """Random access to one written file."""

    def __init__(self, path: str):
        system, base = _open(path)
        local = isinstance(system, arrow_fs.LocalFileSystem)
        self.source = pa.memory_map(base) if local else system.open_input_file(base)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("tokens").type.list_size

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and mask of one sequence; the tokens are a view of the file."""
        batch = self.file.get_batch(number // _ROWS)
        low = number % _ROWS * self.length
        tokens, mask = (batch.column(i).values.slice(low, self.length) for i in (0, 1))
        return tokens.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def span(self, start: int, count: int) -> np.ndarray:
        """``count`` tokens from ``start`` on, over as many batches as they take."""
        step, parts, end = self.length * _ROWS, [], start + count
        for number in range(start // step, -(-end // step)):
            batch = self.file.get_batch(number)
            tokens, mask = (batch.column(i).values for i in (0, 1))
            low, high = max(start - number * step, 0), min(end - number * step, len(tokens))
            if not mask[high - 1].as_py():
                raise ValueError("a document reaches into padding")
            parts.append(tokens.slice(low, high - low).to_numpy())
        return parts[0] if len(parts) == 1 else np.concatenate([*parts, np.zeros(0, np.uint16)])

    def close(self) -> None:
        self.source.close()


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read back from the files: one task reads whole files."""
    # One row per file, so this window is as small as the list of files.
    before = W.orderBy("part", "roll").rowsBetween(W.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, base = _open(row["docs_file"])
                with system.open_input_file(base) as source:
                    docs = pa.ipc.open_file(source).read_all()
                starts, counts = docs["start"].to_numpy(), docs["n_tokens"].to_numpy()
                file = TokenFile(row["tokens_file"])
                crcs = [zlib.crc32(file.span(int(s), int(n)).astype("<u4").tobytes()) for s, n in zip(starts, counts)]
                file.close()
                columns = [docs["doc_id"].combine_chunks(), pa.array(starts + row["start"]), pa.array(counts), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    # One task per file, however few bytes the list has.
    spread = placed.select("start", "tokens_file", "docs_file").repartition(max(1, manifest.count()), "tokens_file")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4_token_files(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_tokens(write_tokens(docs, vocabulary_path(), scratch_path(spark, "tokens")))
