"""Byte-level BPE: an exact backtracking encoder and an offset-table decoder over a public vocabulary file.

The encoder takes the longest vocabulary match at each position (one Aho-Corasick pass finds them all) and accepts it if it may
stand behind the token before it: in the pair table, no merge across their border would have come first. Otherwise it tries the
next shorter prefix token, and when none is left it takes the last token back. This gives the tokens of the merge procedure
without performing merges, in time linear in the piece. Texts are cut into pieces by the vocabulary's pattern; pieces repeat, so
each task remembers those it has seen (the memory is emptied when it outgrows a fixed bound, which changes no result).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The byte-level pattern that cuts a text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_REMEMBERED = 400_000
_ROWS = 500
_SHIFT = 32


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, as letter -> byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """Tables of one vocabulary file. Token numbers inside are merge ranks (bytes first); ``ids`` maps them to ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], byte_letters()
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        names = [*letters, *(a + b for a, b in merges)]
        rank = {name: i for i, name in enumerate(names)}
        if len(rank) != len(names):
            raise ValueError("two merges give the same token; this vocabulary has no unique split")
        self.ids = np.array([model["vocab"][n] for n in names], np.uint32)
        self.id_bytes = [i.tobytes() for i in self.ids]
        self.bytes = [bytes(letters[c] for c in n) for n in names]
        self.left, self.right = list(range(len(names))), list(range(len(names)))
        self.pairs: dict[int, int] = {}
        for i, (a, b) in enumerate(merges, len(letters)):
            self.left[i], self.right[i] = rank[a], rank[b]
            self.pairs[rank[a] << _SHIFT | rank[b]] = i
        number = {b: i for i, b in enumerate(self.bytes)}
        self.shorter = [next((number[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in number), -1) for b in self.bytes]
        self.length = [len(b) for b in self.bytes]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, b in enumerate(self.bytes):
            self.automaton.add_word(b.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.fits = lru_cache(maxsize=1 << 17)(self._fits)
        self.specials = added
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

        # The offset table: bytes of id i are blob[offsets[i]:offsets[i + 1]]; unused ids have none.
        by_id = {int(i): b for i, b in zip(self.ids, self.bytes)} | {i: c.encode() for c, i in added.items()}
        every = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.blob = np.frombuffer(b"".join(every), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in every])])

    def _fits(self, first: int, second: int) -> bool:
        """Whether the merge procedure leaves the border between two adjacent tokens alone.

        Both tokens are taken apart, latest merge first. A pair that faces each other at some time and has a merge earlier than
        every merge undone so far would have been merged across the border.
        """
        pairs, limit = self.pairs, len(self.length)
        while True:
            merged = pairs.get(first << _SHIFT | second)
            if merged is not None and merged < limit:
                return False
            # ``limit``: merges from here on had happened before the tokens looked as they look now. The left token's merge
            # precedes an equal one on its right.
            if first > second:
                if self.left[first] != first:
                    limit, first = first, self.right[first]
                    continue
            elif self.left[second] != second:
                limit, second = second + 1, self.left[second]
                continue
            return True

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token numbers of one piece."""
        longest = [0] * len(piece)
        length = self.length
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - length[token]] = token  # ends ascend, so the last one written is the longest
        size, at, tokens = len(piece), 0, []
        dead = bytearray(size + 1)
        token = longest[0] if size else -1
        fits, shorter = self.fits, self.shorter
        while at < size:
            last = tokens[-1] if tokens else -1
            while token >= 0:
                end = at + length[token]
                if not dead[end] and (last < 0 or fits(last, token)):
                    break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at = end
                token = longest[at] if at < size else -1
            else:
                dead[at] = 1  # no valid way goes on from here
                tokens.pop()
                at -= length[last]
                token = shorter[last]
        return tokens

    def encode_bytes(self, piece: bytes) -> bytes:
        """Ids of one piece as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.id_bytes.__getitem__, self.encode_piece(piece)))

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of a run of ids, and where those of each id begin (one more at the end)."""
        lengths = (self.offsets[1:] - self.offsets[:-1])[ids]
        begins = np.concatenate([[0], np.cumsum(lengths)])
        place = np.repeat(self.offsets[ids] - begins[:-1], lengths) + np.arange(begins[-1])
        return self.blob[place], begins


@lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


class _Irregular(Exception):
    pass


_PIECES = regex.compile(PATTERN)
_SINGLE_SPACE = regex.compile(r"(?<=\S) (?=\S)")


class _Chunks(dict):
    """Ids of the text between two single spaces, with or without the space before it, computed on first use."""

    def __init__(self, lead: str, pieces: Callable[[str], bytes]):
        super().__init__()
        self.lead, self.pieces, self.odd = lead, pieces, False

    def __missing__(self, chunk: str) -> bytes:
        if not self.odd and (not chunk or chunk[0].isspace() or chunk[-1].isspace()):
            raise _Irregular
        found = self.pieces(self.lead + chunk)
        if not self.odd:
            self[chunk] = found
        return found


class TextEncoder:
    """Ids of whole texts, given a function from a piece of text to its ids as bytes.

    A single space between two other characters always begins a new piece, so a text is first split there, which is fast, and
    each chunk is looked up. A text with other white space beside a space is split by a pattern instead.
    """

    def __init__(self, encode_piece: Callable[[str], bytes], special: regex.Pattern | None, specials: dict[str, int]):
        self.memory: dict[str, bytes] = {}
        self.encode_piece, self.special, self.specials = encode_piece, special, specials
        self.first, self.rest = _Chunks("", self._pieces), _Chunks(" ", self._pieces)

    def _pieces(self, chunk: str) -> bytes:
        memory, parts = self.memory, []
        if chunk.isascii() and chunk.strip(" ").isalpha():
            return self.encode_piece(chunk)  # one piece, remembered as a chunk
        for piece in _PIECES.findall(chunk):
            found = memory.get(piece)
            if found is None:
                found = memory[piece] = self.encode_piece(piece)
            parts.append(found)
        return parts[0] if len(parts) == 1 else b"".join(parts)

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        try:
            head, *tail = text.split(" ")
            return self.first[head] + b"".join(map(self.rest.__getitem__, tail))
        except _Irregular:
            self.first.odd = self.rest.odd = True
            head, *tail = _SINGLE_SPACE.split(text)
            found = self.first[head] + b"".join(map(self.rest.__getitem__, tail))
            self.first.odd = self.rest.odd = False
            return found

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of the text; a null text is empty."""
        if not text:
            return b""
        if len(self.rest) + len(self.memory) + len(self.first) > _REMEMBERED:
            for memory in (self.rest, self.first, self.memory):
                memory.clear()
        if self.special is None or not any(s in text for s in self.specials):
            return self._plain(text)
        parts = self.special.split(text)
        number = self.specials
        return b"".join(
            np.uint32(number[p]).tobytes() if i % 2 else self._plain(p) for i, p in enumerate(parts)
        )


@lru_cache(maxsize=4)
def backtracking_encoder(path: str) -> TextEncoder:
    model = load(path)
    return TextEncoder(lambda piece: model.encode_bytes(piece.encode()), model.special, model.specials)


def ids_array(encoded: list[bytes]) -> pa.ListArray:
    """One list of ids per row, without a Python object per id."""
    offsets = np.concatenate([[0], np.cumsum([len(e) // 4 for e in encoded])]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(encoded), np.int32))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _schema(df: DataFrame, keep: list[str], *extra: T.StructField) -> T.StructType:
    return T.StructType([*(df.schema[k] for k in keep), *extra])


def _decode_lists(model: ByteBpe, lists: pa.ListArray) -> pa.StringArray:
    lists = lists.fill_null([]) if lists.null_count else lists
    bounds, ids = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    texts = (model.decode(ids[low:high])[0].tobytes().decode("utf-8", "replace") for low, high in zip(bounds[:-1], bounds[1:]))
    return pa.array(texts, pa.string(), size=len(lists))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, so what a task holds besides one incoming batch stays small."""
    for batch in batches:
        for low in range(0, batch.num_rows, _ROWS):
            yield batch.slice(low, _ROWS)


def encode_texts(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``ids`` (array<int>): the ids of each whole ``text``; an empty array for a null or empty text.

    Row-wise and without a shuffle: repeated ids and rows, nulls in ``keep`` and further columns of ``docs`` do not matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = backtracking_encoder(path)
        for batch in _slices(batches):
            encoded = [encoder.encode(t) for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], ids_array(encoded)], [*keep, "ids"])

    out = _schema(docs, keep, T.StructField("ids", T.ArrayType(T.IntegerType())))
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, out)


def decode_texts(tokens: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``decoded`` (string): the text of each row's ``ids``, special tokens shown; '' for null or no ids.

    Bytes that are not UTF-8 become U+FFFD, as a lossy decoder has it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            texts = _decode_lists(model, batch.column(len(keep)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], texts], [*keep, "decoded"])

    out = _schema(tokens, keep, T.StructField("decoded", T.StringType()))
    return tokens.select(*keep, F.col("ids").alias("__ids")).mapInArrow(run, out)


def round_trip(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``keep``, ``ids`` and ``decoded`` of every text: both directions in one pass over the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, model = backtracking_encoder(path), load(path)
        for batch in _slices(batches):
            ids = ids_array([encoder.encode(t) for t in batch.column(len(keep)).to_pylist()])
            columns = [*batch.columns[: len(keep)], ids, _decode_lists(model, ids)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "ids", "decoded"])

    extra = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, _schema(docs, keep, *extra))


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def digests(coded: DataFrame, *more: str) -> DataFrame:
    """Number and digests of each row's ids and decoded text, and further columns."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(round_trip(docs, vocabulary_path(), ["doc_id"]))
