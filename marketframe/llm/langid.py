"""Language identification with bitmask n-gram filters.

Texts become lower-case letters with a border where anything else stands; n-grams are runs of letters, with a border at either end at most.
An n-gram belongs to a language if its rate among that language's n-grams is at least ``least`` and at least ``share`` of its highest rate in
any language. As rates of a language add up to one, it has at most ``1 / least`` n-grams, so the model's size is bounded whatever the corpus holds.

The sets are one bit-sliced Bloom filter: a table of positions, each with a mask of one bit per language. The masks at an n-gram's positions,
ANDed, are all languages that may contain it, found at once. Summed over a text they give a count of hits per language. A language
whose filter says yes to a fraction ``f`` of unknown n-grams has ``(hits - n f) / (1 - f)`` true ones of ``n``; the language with most decides.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketframe.llm.words import mix
from marketframe.session import broadcast_if_small, scratch_path

WIDTHS = (3, 4)
UNKNOWN = "und"
MOST_LANGUAGES = 4096
_SLICE_CHARS = 1_000_000
_HELD = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def folding() -> np.ndarray:
    """For every code point its lower-case letter, or 0 if it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def letters(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all texts with single borders (0) between and around words, and the text each belongs to."""
    joined = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(texts) + 1), [1, *(len(t) + 1 for t in texts)]) - 1
    row[0] = 0
    folded = folding()[joined]
    keep = folded > 0
    keep[1:] |= (folded[1:] == 0) & (folded[:-1] > 0)
    keep[0] = True
    return folded[keep], row[keep]


def grams(texts: Sequence[str], widths: Sequence[int] = WIDTHS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every n-gram of every text, and the number of its text.

    A border belongs to the text before it, so an n-gram's last letter tells its text.
    """
    stream, row = letters(texts)
    inside = stream > 0
    hashes, rows = [], []
    for width in widths:
        count = len(stream) - width + 1
        if count <= 0:
            continue
        whole = np.ones(count, bool)
        for i in range(1, width - 1):
            whole &= inside[i : i + count]
        if width == 2:
            whole &= inside[:count] | inside[1 : 1 + count]
        at = np.flatnonzero(whole)
        total = np.full(len(at), np.uint64(width))
        for i in range(width):
            total = total * _BASE + stream[at + i]
        hashes.append(mix(total))
        rows.append(row[at + (1 if width > 2 else width - 1)])
    return np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate([np.zeros(0, np.int64), *rows])


def _slices(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about a million characters together, or one longer text; null texts are empty."""
    low = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= _SLICE_CHARS or i == len(texts) - 1:
            yield low, [t or "" for t in texts[low : i + 1]]
            low, size = i + 1, 0


def _sum_equal(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, place = np.unique(hashes, return_inverse=True)
    return values, np.bincount(place, counts, len(values)).astype(np.int64)


def gram_counts(docs: DataFrame, widths: Sequence[int] = WIDTHS) -> DataFrame:
    """``(lang, gram, n)`` over ``(text, lang)``. Tasks send one row per language and n-gram, not per occurrence."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for lang, (hashes, counts) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(hashes), pa.string()), pa.array(hashes.view(np.int64)), pa.array(counts)], ["lang", "gram", "n"]
                )
            held.clear()

        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for low, part in _slices(batch.column(0).to_pylist()):
                hashes, rows = grams(part, widths)
                names, number = np.unique(langs[low : low + len(part)].astype(str), return_inverse=True)
                for i, lang in enumerate(names.tolist()):
                    found, counts = np.unique(hashes[number[rows] == i], return_counts=True)
                    if lang in held:
                        found, counts = _sum_equal(np.concatenate([held[lang][0], found]), np.concatenate([held[lang][1], counts]))
                    held[lang] = found, counts.astype(np.int64)
                if sum(len(h) for h, _ in held.values()) > _HELD:
                    yield from told()
        yield from told()

    parts = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def typical(counts: DataFrame, least: float = 1e-5, share: float = 0.5) -> DataFrame:
    """``(lang, gram)``: the n-grams of each language's set."""
    totals = broadcast_if_small(counts.groupBy("lang").agg(F.sum("n").alias("total")))
    rates = counts.join(totals, "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("rate"))
    highest = F.max("rate").over(W.partitionBy("gram"))  # a gram has one row per language
    return rates.withColumn("highest", highest).where((F.col("rate") >= least) & (F.col("rate") >= share * F.col("highest"))).select("lang", "gram")


@dataclass(frozen=True)
class Filters:
    """Learned languages, the sliced table (positions x 64-language words) and each language's rate of false positives."""

    languages: tuple[str, ...]
    table: np.ndarray
    hashes: int
    widths: tuple[int, ...]

    @property
    def false_positives(self) -> np.ndarray:
        filled = [((self.table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(self.languages))]
        return np.array(filled, np.float64).reshape(-1) ** self.hashes

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """All languages that may contain each n-gram, one bit each."""
        limit = np.uint64(len(self.table) - 1)
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        found = self.table[(hashes & limit).astype(np.int64)]
        for i in range(1, self.hashes):
            found = found & self.table[((hashes + np.uint64(i) * step) & limit).astype(np.int64)]
        return found

    def decide(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text the number of the language (-1 without letters), the score and the number of n-grams."""
        hashes, rows = grams(texts, self.widths)
        counts = np.bincount(rows, minlength=len(texts)).astype(np.float64)
        masks, wrong = self.masks(hashes), self.false_positives
        true = np.zeros((len(texts), len(self.languages)))
        for i, f in enumerate(wrong):
            hit = ((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(bool)
            hits = np.bincount(rows[hit], minlength=len(texts))
            true[:, i] = np.maximum(0.0, (hits - counts * f) / max(1 - f, 1e-9))
        best = np.where(counts > 0, true.argmax(1), -1)
        top, every = true.max(1), true.sum(1)
        return best, np.where(every > 0, top / np.where(every > 0, every, 1), 0.0), counts.astype(np.int64)


def learn(
    docs: DataFrame, widths: Sequence[int] = WIDTHS, least: float = 1e-5, share: float = 0.5, bits: int = 12, hashes: int = 4
) -> Filters:
    """Filters from all rows of ``docs`` with a text and a language, whole texts; ``bits`` positions per n-gram of the largest set.

    Languages with most n-grams come first, equal ones by name. More than 4096 languages raise.
    """
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "gram-counts")
    gram_counts(docs, widths).write.parquet(path)
    counts = spark.read.parquet(path)
    known = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "lang").limit(MOST_LANGUAGES + 1).collect()
    if len(known) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = tuple(r.lang for r in known)
    words = max(1, -(-len(languages) // 64))
    chosen = scratch_path(spark, "gram-sets")
    typical(counts, least, share).write.parquet(chosen)
    sets = spark.read.parquet(chosen)
    largest = sets.groupBy("lang").count().agg(F.max("count")).first()[0] or 0  # at most 1 / least
    size = 1 << max(6, int(np.ceil(np.log2(max(1, largest * bits)))))
    numbers = broadcast_if_small(spark.createDataFrame([(n, i // 64, i % 64) for i, n in enumerate(languages)] or [], "lang string, word int, bit int"))
    step = F.shiftrightunsigned("gram", 32).bitwiseOR(F.lit(1).cast("long"))
    # Only the low bits matter, so the sums are taken over low halves and cannot overflow.
    low = F.col("gram").bitwiseAND(F.lit(0xFFFFFFFF))
    places = F.array(*[(low + step * i).bitwiseAND(F.lit(size - 1).cast("long")) for i in range(hashes)])
    marked = (
        sets.join(numbers, "lang")
        .select(F.explode(places).alias("place"), "word", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit")).alias("mask"))
        .groupBy("place", "word").agg(F.bit_or("mask").alias("mask"))
        .toArrow()
    )  # at most one row per position and word of the table
    table = np.zeros((size, words), np.uint64)
    table[marked["place"].to_numpy(), marked["word"].to_numpy()] = marked["mask"].to_numpy().view(np.uint64)
    return Filters(languages, table, hashes, tuple(widths))


def identify(docs: DataFrame, filters: Filters, keep: Sequence[str]) -> DataFrame:
    """``keep``, ``lang_pred``, ``score`` (share of the winner among all corrected hits) and ``n_grams`` per row.

    Whole texts. A null text or one without a letter is ``und`` with score 0, and so is every text if no language was learned. A text of which no
    n-gram is known gets the first language with score 0; ties go to the first too. ``keep`` must not name a result.
    """
    taken = {"lang_pred", "score", "n_grams"} & set(keep)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are results")
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(filters)
    names = [*keep, "lang_pred", "score", "n_grams"]
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("n_grams", "long")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        languages = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            best, score, count = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
            for _, part in _slices(batch.column(len(keep)).to_pylist()):
                if model.languages:
                    found = model.decide(part)
                else:
                    found = np.full(len(part), -1), np.zeros(len(part)), np.bincount(grams(part, model.widths)[1], minlength=len(part))
                for column, values in zip((best, score, count), found):
                    column.append(values)
            told = languages[np.concatenate(best)].tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(told, pa.string()), pa.array(np.concatenate(score)), pa.array(np.concatenate(count).astype(np.int64))],
                names,
            )

    whole = "_".join(["", *keep, "text"])  # longer than any kept name, so it clashes with none
    return docs.select(*keep, F.col("text").alias(whole)).mapInArrow(predict, schema)


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether a document is kept out of learning, by its id; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts == part


def op11_language_id(spark, sf_dir: str) -> DataFrame:
    """Rows without id are neither learned from nor held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    filters = learn(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs, filters, ["doc_id"])
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score", "n_grams")
