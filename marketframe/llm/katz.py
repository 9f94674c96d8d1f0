"""A Katz backoff model of order three over words and the scores it gives whole texts.

With c counted in the training texts, h the two words before w and h' the last of them:

    p(w | h)  = d3(c) c / (c(h) + 1)   for a triple seen c = c(h, w) > 0 times,  else a(h) p(w | h')
    p(w | h') = d2(c) c / (c(h') + 1)  for a pair seen c = c(h', w) > 0 times,   else a(h') p(w)
    p(w)      = d1(c) c / (N + 1)      for a word seen c = c(w) > 0 times,       else the mass left, for one unknown word

The d are Good-Turing discounts for counts up to 5 (Katz's form, from the numbers of triples, pairs and words with each count; 1 where these
numbers give none). A backoff weight is what the words seen after a history leave of 1, over what the same words leave of the
lower model, so every distribution sums to one exactly; the 1 in the denominators keeps that mass above zero for every history. A history
never seen backs off with weight 1. Texts begin with two starts.

Work is dealt by hashes, packed (see ``packs``). First by word, or by word and word before for frequent words: one task has all triples that end in such
a pair, hence the counts of triple and pair, and of the word (those of frequent words are counted beforehand). A text's events stay with its flush, a
slice of texts: a task gets the different triples of a flush, in an order that the flush keeps, and returns their counts in the same order. What
it can't know goes on to a task by history (the word before, or both words before where the nearer one is frequent): the numbers that make
backoff weights, and requests for the weights of unseen triples. Numbers of frequent histories of one word are added up for all tasks. Counts and weights meet in
the flush, where each different triple gets one value. Between the steps lie tables in the shared folder, partitioned by kind.

Disk is what this job needs most, as nearly every triple can be a different one. So the most frequent words travel as codes of two bytes, columns
are compressed, the ranges are dealt in a few passes, and the shuffles of a pass go with it. Texts are read once for each pass of the first
step; should they not come in the same order and partitions again, which digests tell, there is one pass.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.packs import bucket_of, group_starts, press, text_bytes, unpress
from marketframe.llm.words import hash_words, mix, row_slices, text_buffers
from marketframe.session import scratch_path, shuffles_dropped

LARGEST = 5
_SLICE_BYTES = 7_000_000
_BUCKET_BYTES = 6_000_000
#: Words counted beforehand at most: a word outside them has a smaller share of all tokens than one in this many.
_MOST_FREQUENT = 4096
#: Passes over the ranges of triples, each with a reading of the texts, and over those of histories.
_PASSES = 2
_HISTORY_PASSES = 4
#: Words with a code of two bytes at most, and the code that stands for any other word.
_MOST_CODES = _OTHER = 0xFFFF
#: A word needs two bytes or more, so at most half as many words can occur as often as once in so many bytes.
_RARE = 1 << 23
_SLOT_BITS = 18
_KEY_BYTES = 6
_KEY_MASK = np.uint64((1 << 8 * _KEY_BYTES) - 1)
START, END = mix(np.array([0x5354415254, 0x454E44], np.uint64))
#: Numbers of a history of one word: of its events with each small count, with each small count in the lower model, and the sum of the larger of these.
_OF_HISTORY = 2 * LARGEST + 1
#: Frequent histories in one row.
_ROWFUL = 64
_CELLS = [f"c{i}" for i in range(11)]
_ROW = "bucket int, kind string, flush long, " + ", ".join(f"{c} binary" for c in _CELLS)
_NAMES = ["bucket", "kind", "flush", *_CELLS]
_TYPES = [pa.int32(), pa.string(), pa.int64(), *[pa.binary()] * len(_CELLS)]
#: Kinds of rows: triples by their end; per flush its texts and events; counts of its triples; corpus numbers; those of frequent histories; answers.
TRIPLES, TEXTS, COUNTS, NUMBERS, FREQUENT, ANSWERS = "triples texts counts numbers frequent answers".split()
#: By history: numbers of those of one and of two words, requests for their weights.
HISTORIES, LONG_HISTORIES, REQUESTS = "histories2 histories3 requests".split()


def _batches(rows: Iterator[tuple], at_most: int = 512) -> Iterator[pa.RecordBatch]:
    waiting = []
    for bucket, kind, flush, *cells in rows:
        waiting.append((bucket, kind, flush, *cells, *[None] * (len(_CELLS) - len(cells))))
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


def _run_lengths(starts: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.append(starts, total))


def _both(word: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(word + mix(before ^ START))


class Frequent:
    """The frequent words, whose work is spread by a neighbour as well, with their counts in training texts; starts and ends are among them.

    ``coded`` words, the most frequent first, have codes of two bytes.
    """

    def __init__(self, counts: dict[int, int], texts: int, coded: list[int] = ()):
        every = {**counts, int(START): texts, int(END): texts}
        self.words = np.array(sorted(every), np.uint64)
        self.counts = np.array([every[int(w)] for w in self.words], np.int64)
        #: Those that are tokens: the starts are histories only.
        self.of_tokens = self.counts[self.words != START]
        self.texts = texts
        self.coded = np.array([START, END, *coded], np.uint64)[:_MOST_CODES]
        self._code = np.argsort(self.coded)
        self._sorted = self.coded[self._code]
        self._first = np.searchsorted(self._sorted, np.arange(1 << _SLOT_BITS, dtype=np.uint64) << np.uint64(64 - _SLOT_BITS)).astype(np.int32)
        self._key_code = np.argsort(self.coded & _KEY_MASK)
        self._sorted_keys = (self.coded & _KEY_MASK)[self._key_code]

    def codes(self, words: np.ndarray) -> np.ndarray:
        last = len(self._sorted) - 1
        at = np.minimum(self._first[words >> np.uint64(64 - _SLOT_BITS)], last)
        behind = np.flatnonzero(self._sorted[at] < words)
        while len(behind):  # a few words share their first bits
            behind = behind[at[behind] < last]
            at[behind] += 1
            behind = behind[self._sorted[at[behind]] < words[behind]]
        return np.where(self._sorted[at] == words, self._code[at], _OTHER).astype(np.uint16)

    def key_codes(self, keys: np.ndarray) -> np.ndarray:
        """Codes of words by their lowest bytes (any of them, should these be equal)."""
        at = np.minimum(np.searchsorted(self._sorted_keys, keys), len(self._sorted_keys) - 1)
        return np.where(self._sorted_keys[at] == keys, self._key_code[at], _OTHER).astype(np.uint16)

    def pack_words(self, words: np.ndarray, codes: np.ndarray, width: int = 8) -> bytes:
        """Codes, then the hashes of words without one, or their lowest bytes (``width``)."""
        cell, others = press(codes), words[codes == _OTHER]
        planes = others.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        return len(cell).to_bytes(4, "little") + cell + planes.tobytes()

    def unpack_words(self, cell: bytes, width: int = 8) -> np.ndarray:
        end = 4 + int.from_bytes(cell[:4], "little")
        codes = unpress(cell[4:end])
        others = np.frombuffer(cell, np.uint8, offset=end).reshape(-1, width)
        wide = np.zeros((len(others), 8), np.uint8)
        wide[:, :width] = others
        other = codes == _OTHER
        words = self.coded[np.where(other, 0, codes)]
        words[other] = wide.view("<u8").ravel()
        return words & _KEY_MASK if width == _KEY_BYTES else words

    def place(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are frequent, and their places."""
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return self.words[at] == words, at

    def dealt(self, words: np.ndarray, neighbour: np.ndarray) -> np.ndarray:
        """What a word is dealt by: itself or, for a frequent one, both."""
        frequent, _ = self.place(words)
        keys = words.copy()
        keys[frequent] = _both(words[frequent], neighbour[frequent])
        return keys


def _events(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """The words of each text, then its end; where texts begin in them; and their lengths."""
    words, _, _, first = hash_words(data, offsets, lower=True)
    lengths = np.diff(first) + 1
    ends = np.cumsum(lengths) - 1
    tokens = np.empty(len(words) + len(lengths), np.uint64)
    inside = np.ones(len(tokens), bool)
    inside[ends] = False
    tokens[inside], tokens[ends] = words, END
    return tokens, np.append(0, ends[:-1] + 1)[: len(lengths)], lengths


def _shifted(values: np.ndarray, begins: np.ndarray, start) -> np.ndarray:
    """What comes before each token of a text."""
    result = np.empty_like(values)
    result[1:] = values[:-1]
    result[begins] = start
    return result


def _differs(*columns: np.ndarray) -> np.ndarray:
    """Where a row is unlike the one before it in any of the columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice of texts how often each word occurs, in all and in training texts; under no word, all tokens and the number of training texts."""
    for batch in batches:
        held = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        data, offsets = text_buffers(batch.column(2))
        for low, high in row_slices(offsets, _SLICE_BYTES):
            part = offsets[low : high + 1]
            words, _, _, first = hash_words(data[part[0] : part[-1]], part - part[0], lower=True)
            trained = np.repeat(~held[low:high], np.diff(first))
            found, place = np.unique(words, return_inverse=True)
            counts = np.bincount(place, minlength=len(found)), np.bincount(place, trained, len(found))
            every, train = len(words) + high - low, int((~held[low:high]).sum())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.append(found.view(np.int64), 0), mask=np.arange(len(found) + 1) == len(found)), pa.array(np.append(counts[0], every), pa.int64()),
                pa.array(np.append(counts[1], train).astype(np.int64)),
            ], ["word", "n", "trained"])


def frequent_words(picked: DataFrame, buckets: int, size: int = 0) -> Frequent:
    """The words with a larger share of all tokens than half a range of words would have, ``_MOST_FREQUENT`` at most, and those with a code.

    ``size`` is that of all texts in bytes. A word with a code is not rarer than once in ``_RARE`` bytes, so that few words are ranked.
    """
    counts = picked.mapInArrow(_word_counts, "word long, n long, trained long").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("trained").alias("trained")
    )
    named = F.col("word").isNotNull()
    most = min(_MOST_FREQUENT, 2 * buckets)
    top = counts.where(~named | (F.col("n") >= size // _RARE)).orderBy(named, F.desc("n"), "word").limit(_MOST_CODES).collect()
    if not top:
        return Frequent({}, 0)
    share = top[0].n / (2 * buckets)
    return Frequent({r.word % 2**64: r.trained for r in top[1 : most + 1] if r.n > share}, top[0].trained, [r.word % 2**64 for r in top[1:]])


def _digest(ids: pa.Array, held: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> bytes:
    digest = hashlib.blake2b(digest_size=16)
    for x in (ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(), held, offsets, data):
        digest.update(np.ascontiguousarray(x).view(np.uint8))
    return digest.digest()


def _send_triples(buckets: int, frequent: Frequent, number: int, passes: int):
    """The events of pass ``number``, those of every text in it."""
    start = frequent.codes(np.array([START]))[0]

    def flush_rows(flush: int, ids: pa.Array, held: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
        words, begins, lengths = _events(data, offsets)
        codes = frequent.codes(words)
        text = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        before, before_codes = _shifted(words, begins, START), _shifted(codes, begins, start)
        before2, before2_codes = _shifted(before, begins, START) & _KEY_MASK, _shifted(before_codes, begins, start)
        bucket = _narrow(bucket_of(frequent.dealt(words, before), buckets), buckets)
        order = np.flatnonzero(bucket % passes == number)
        order = order[np.lexsort((before2[order], before[order], words[order], bucket[order]))]  # stable, so by text within a triple
        bucket = bucket[order]
        words, before, before2, text = words[order], before[order], before2[order], text[order]
        new_word = _differs(bucket, words)
        new_pair = new_word | _differs(before)
        new_triple = new_pair | _differs(before2)
        entry = np.flatnonzero(new_triple | _differs(text))
        counts, text = _run_lengths(entry, len(words)), text[entry]
        new_word, new_pair, new_triple = new_word[entry], new_pair[entry], new_triple[entry]
        triple = np.flatnonzero(new_triple)
        pair = np.flatnonzero(new_pair[triple])  # among the triples
        word = np.flatnonzero(new_word[triple[pair]])  # among the pairs
        trained = np.add.reduceat(np.where(held[text], 0, counts), triple)
        word_runs, pair_runs = _run_lengths(word, len(pair)), _run_lengths(pair, len(triple))
        at = entry[triple]
        at_pair = at[pair]
        at_word = at_pair[word]
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        yield (
            flush % buckets // passes * passes, TEXTS, flush, ids.fill_null(0).to_numpy().tobytes(), np.packbits(known).tobytes(), np.packbits(held).tobytes(), press(lengths),
            press(text), press(counts), press(_run_lengths(triple, len(entry))), press(pair_runs), press(word_runs), np.packbits(words[at_word] == END).tobytes(),
            _digest(ids, held, data, offsets),
        )
        found, low_word = np.unique(bucket[at_word], return_index=True)
        low_pair = np.append(word, len(pair))[np.append(low_word, len(word))]
        low_triple = np.append(pair, len(triple))[low_pair]
        low_word = np.append(low_word, len(word))
        for i, b in enumerate(found.tolist()):
            w, p, t = (slice(x[i], x[i + 1]) for x in (low_word, low_pair, low_triple))
            yield (
                b, TRIPLES, flush, frequent.pack_words(words[at_word[w]], codes[order[at_word[w]]]), press(word_runs[w]),
                frequent.pack_words(before[at_pair[p]], before_codes[order[at_pair[p]]]), press(pair_runs[p]),
                frequent.pack_words(before2[at[t]], before2_codes[order[at[t]]], _KEY_BYTES), press(trained[t]),
            )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        flush = TaskContext.get().partitionId() << 24
        for batch in batches:
            held = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            data, offsets = text_buffers(batch.column(2))
            for low, high in row_slices(offsets, _SLICE_BYTES):
                part = offsets[low : high + 1]
                yield from flush_rows(
                    flush * passes + number, batch.column(0).slice(low, high - low), held[low:high], data[part[0] : part[-1]], part - part[0]
                )
                flush += 1

    return lambda batches: _batches(rows(batches), 64)


def _narrow(bucket: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges in few bytes, which sort faster."""
    return bucket.astype(np.min_scalar_type(buckets))


def _classes(counts: np.ndarray) -> np.ndarray:
    """How many counts are 1, 2 and so on up to one above the largest that is discounted."""
    return np.bincount(np.minimum(counts, LARGEST + 2), minlength=LARGEST + 3)[1 : LARGEST + 2]


def _count_triples(buckets: int, frequent: Frequent):
    """All triples of one range: counts in the order of each flush, numbers per history, requests."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        cells, columns = [], []
        for row in _rows(batches):
            if row[1] == TEXTS:
                yield row
                continue
            bucket, _, flush, word_cell, word_runs, history_cell, pair_runs, key_cell, trained = row[:9]
            word_runs, pair_runs = unpress(word_runs), unpress(pair_runs)
            word = np.repeat(np.repeat(frequent.unpack_words(word_cell), word_runs), pair_runs)
            before = np.repeat(frequent.unpack_words(history_cell), pair_runs)
            columns.append((word, before, frequent.unpack_words(key_cell, _KEY_BYTES), unpress(trained)))
            pair = np.cumsum(pair_runs) - pair_runs
            cells.append((flush, pair.astype(np.int32), pair[np.cumsum(word_runs) - word_runs].astype(np.int32)))
        if not cells:
            return
        bounds = np.cumsum([0, *(len(c[0]) for c in columns)])
        words, before, before2, trained = (np.concatenate(x) for x in zip(*columns))
        columns.clear()
        order = np.lexsort((before2, before, words))
        words, before, before2 = words[order], before[order], before2[order]
        new_word = _differs(words)
        new_pair = new_word | _differs(before)
        new_triple = new_pair | _differs(before2)
        number = np.empty(len(order), np.int32)
        number[order] = np.cumsum(new_triple, dtype=np.int32) - 1
        first = np.flatnonzero(new_triple)
        pair_of = (np.cumsum(new_pair, dtype=np.int32) - 1)[first]
        first_pair = np.flatnonzero(new_pair)
        word_of = (np.cumsum(new_word, dtype=np.int32) - 1)[first_pair]
        c3 = np.bincount(number, trained).astype(np.int64)
        pair_count = np.bincount(pair_of, c3).astype(np.int64)
        word_count = np.bincount(word_of, pair_count).astype(np.int64)
        word, pair_history = words[new_word], before[first_pair]
        before, before2 = before[first], before2[first]
        del words, trained, order, new_word, new_pair, new_triple, first
        is_frequent, place = frequent.place(word)
        here = word_count[~is_frequent]  # a frequent word is in many ranges
        word_count[is_frequent] = frequent.counts[place[is_frequent]]
        of_pair = word_count[word_of]
        numbers = [*_classes(c3), *_classes(pair_count), *_classes(here), here.sum(), (here > 0).sum()]
        for i, value in enumerate(numbers):
            yield i, NUMBERS, int(value)
        for (flush, pair, word), low, high in zip(cells, bounds[:-1], bounds[1:]):
            triple = number[low:high]
            pairs = pair_of[triple[pair]]
            yield bucket, COUNTS, flush, press(c3[triple]), press(pair_count[pairs]), press(of_pair[pair_of[triple[word]]])

        seen = np.flatnonzero(pair_count > 0)
        yield from _history_rows(pair_history[seen], pair_count[seen], of_pair[seen], buckets, frequent)
        seen = np.flatnonzero(c3 > 0)
        yield from _long_history_rows(before[seen], before2[seen], c3[seen], pair_count[pair_of[seen]], buckets, frequent)
        asking = np.flatnonzero(c3[number] == 0)
        flush = np.searchsorted(bounds, asking, "right") - 1
        triple = number[asking]
        flushes = np.array([c[0] for c in cells], np.int64)
        unseen = pair_count[pair_of[triple]] == 0
        yield from _request_rows(bucket, flushes, flush, asking - bounds[flush], before[triple], before2[triple], unseen, buckets, frequent)

    return lambda batches: _batches(rows(batches), 16)


def _numbers_of(group: np.ndarray, groups: int, own: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """The numbers of each history, one column each."""
    table = [np.bincount(group[c == r], minlength=groups) for c in (own, lower) for r in range(1, LARGEST + 1)]
    large = lower > LARGEST
    return np.array([*table, np.bincount(group[large], lower[large], groups)]).astype(np.int64)


def _ranges(bucket: np.ndarray) -> Iterator[tuple]:
    """Sorted ranges with their bounds."""
    found, begins = np.unique(bucket, return_index=True)
    yield from zip(found.tolist(), begins, np.append(begins[1:], len(bucket)))


def _history_rows(histories: np.ndarray, own: np.ndarray, lower: np.ndarray, buckets: int, frequent: Frequent) -> Iterator[tuple]:
    is_frequent, place = frequent.place(histories)
    table = _numbers_of(place[is_frequent], len(frequent.words), own[is_frequent], lower[is_frequent])
    for i in range(0, table.shape[1], _ROWFUL):
        if table[:, i : i + _ROWFUL].any():
            yield i // _ROWFUL, FREQUENT, 0, table[:, i : i + _ROWFUL].tobytes()
    order = np.flatnonzero(~is_frequent)
    order = order[np.argsort(histories[order])]
    histories, own, lower = histories[order], own[order], lower[order]
    starts = group_starts(histories)
    group = np.cumsum(_differs(histories)) - 1
    table, counts, histories = _numbers_of(group, len(starts), own, lower), np.bincount(group, own, len(starts)).astype(np.int64), histories[starts]
    codes = frequent.codes(histories)
    for bucket, low, high in _ranges(bucket_of(histories, buckets)):
        cells = press(table[:-1, low:high].ravel()), press(table[-1, low:high]), press(counts[low:high])
        yield bucket, HISTORIES, 0, frequent.pack_words(histories[low:high], codes[low:high]), *cells


def _long_history_rows(before, before2, own, lower, buckets: int, frequent: Frequent) -> Iterator[tuple]:
    bucket = _narrow(bucket_of(frequent.dealt(before, before2), buckets), buckets)
    order = np.lexsort((before2, before, bucket))
    before, before2, own, lower, bucket = before[order], before2[order], np.minimum(own[order], LARGEST + 1), lower[order], bucket[order]
    codes, codes2 = frequent.codes(before), frequent.key_codes(before2)
    for number, low, high in _ranges(bucket):
        runs = group_starts(before[low:high])
        yield (
            number, LONG_HISTORIES, 0, frequent.pack_words(before[low + runs], codes[low + runs]), press(_run_lengths(runs, high - low)),
            frequent.pack_words(before2[low:high], codes2[low:high], _KEY_BYTES), press(own[low:high]), press(lower[low:high]),
        )


def _request_rows(source: int, flushes, flush, position, before, before2, unseen, buckets: int, frequent: Frequent) -> Iterator[tuple]:
    """Requests for what the histories of unseen triples add to the score, with whether the pair is unseen too; ``position`` is that in the flush's range."""
    bucket = _narrow(bucket_of(frequent.dealt(before, before2), buckets), buckets)
    order = np.argsort(bucket, kind="stable")
    flush, position, before, before2, unseen, bucket = (x[order] for x in (flush, position, before, before2, unseen, bucket))
    codes, codes2 = frequent.codes(before), frequent.key_codes(before2)
    for number, low, high in _ranges(bucket):
        runs = group_starts(flush[low:high])
        yield (
            number, REQUESTS, source, flushes[flush[low + runs]].tobytes(), press(_run_lengths(runs, high - low)), press(position[low:high]),
            frequent.pack_words(before[low:high], codes[low:high]), frequent.pack_words(before2[low:high], codes2[low:high], _KEY_BYTES),
            np.packbits(unseen[low:high]).tobytes(),
        )


def discounts(numbers: np.ndarray) -> np.ndarray:
    """Good-Turing discounts for counts 1 to 5 from how many events have counts 1 to 6."""
    n, k = [0.0, *map(float, numbers)], LARGEST
    result = np.ones(k)
    common = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        if n[r] and n[r + 1] and common < 1:
            d = ((r + 1) * n[r + 1] / (n[r] * r) - common) / (1 - common)
            if 0 < d <= 1:
                result[r - 1] = d
    return result


class Model:
    """The corpus-wide numbers."""

    def __init__(self, numbers: np.ndarray):
        k = LARGEST
        triples, pairs, words = numbers[: 3 * (k + 1)].reshape(3, k + 1)
        self.tokens, self.vocabulary = int(numbers[3 * k + 3]), int(numbers[3 * k + 4])
        self.triple, self.pair, self.word = discounts(triples), discounts(pairs), discounts(words)
        r = np.arange(1, k + 1)
        self.unknown = (1 + ((1 - self.word) * r * words[:k]).sum()) / (self.tokens + 1)

    @staticmethod
    def _backoff(own: np.ndarray, lower: np.ndarray, table: np.ndarray, rest: np.ndarray, denominator) -> np.ndarray:
        r = np.arange(1, LARGEST + 1)[:, None]
        left = 1 + ((1 - own)[:, None] * r * table[:LARGEST]).sum(0)
        return left / (1 - (rest + (lower[:, None] * r * table[LARGEST:]).sum(0)) / denominator)

    def backoff(self, table: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """a(h') (c(h') + 1) from the numbers of each history of one word (one column each)."""
        return self._backoff(self.pair, self.word, table, rest, self.tokens + 1)

    def long_backoff(self, table: np.ndarray, rest: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """a(h) (c(h) + 1) for histories of two words, from the counts c(h') of their last word as well."""
        return self._backoff(self.triple, self.pair, table, rest, counts + 1)


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each key that is wanted, 0 for one that is not there."""
    if not len(keys):
        return np.zeros(len(wanted))
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], 0.0)


def _answer(model: Model, frequent: Frequent, frequent_weights: np.ndarray):
    """What the histories of one range add to the scores of the triples that ask."""

    def weights_of(short: list[tuple], long: list[tuple]) -> tuple[np.ndarray, ...]:
        keys, counts, weights = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
        if short:
            whole = np.concatenate([c[0] for c in short])
            keys, group = np.unique(whole, return_inverse=True)
            numbers = np.concatenate([c[1] for c in short], axis=1)
            numbers = np.array([np.bincount(group, x, len(keys)) for x in numbers])
            counts, weights = numbers[-1], np.log10(model.backoff(numbers[: 2 * LARGEST], numbers[2 * LARGEST]))
        long_keys, long_weights = np.zeros(0, np.uint64), np.zeros(0)
        if long:
            before, before2, own, lower = (np.concatenate(x) for x in zip(*long))
            long_keys, first, group = np.unique(_both(before, before2), return_index=True, return_inverse=True)
            before = before[first]
            numbers = _numbers_of(group, len(long_keys), own, lower)
            is_frequent, place = frequent.place(before)
            times = np.where(is_frequent, frequent.counts[place], _look_up(keys, counts, before))
            long_weights = np.log10(model.long_backoff(numbers[:-1], numbers[-1], times))
        return keys, counts, weights, long_keys, long_weights

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        short, long, asked = [], [], []
        for row in _rows(batches):
            if row[1] == HISTORIES:
                keys, table = frequent.unpack_words(row[3]), unpress(row[4])
                short.append((keys, np.vstack([table.reshape(2 * LARGEST, len(keys)), unpress(row[5]), unpress(row[6])])))
            elif row[1] == LONG_HISTORIES:
                before = np.repeat(frequent.unpack_words(row[3]), unpress(row[4]))
                long.append((before, frequent.unpack_words(row[5], _KEY_BYTES), unpress(row[6]), unpress(row[7])))
            else:
                asked.append(row)
        if not asked:
            return
        keys, counts, weights, long_keys, long_weights = weights_of(short, long)
        short.clear()
        long.clear()
        answers = []
        for _, _, source, flushes, runs, position, before, before2, unseen, *_ in asked:
            before, position = frequent.unpack_words(before), unpress(position)
            unseen = np.unpackbits(np.frombuffer(unseen, np.uint8), count=len(before))
            is_frequent, place = frequent.place(before)
            times = np.where(is_frequent, frequent.counts[place], _look_up(keys, counts, before))
            values = np.where(is_frequent, frequent_weights[place], _look_up(keys, weights, before)) * unseen - np.log10(times + 1)
            values += _look_up(long_keys, long_weights, _both(before, frequent.unpack_words(before2, _KEY_BYTES)))
            flush = np.repeat(np.frombuffer(flushes, np.int64), unpress(runs))
            answers.append((flush, np.full(len(flush), source, np.int64), position, values))
        flush, source, position, values = (np.concatenate(x) for x in zip(*answers))
        order = np.lexsort((position, source, flush))
        flush, source, position, values = flush[order], source[order], position[order], values[order]
        for number, low, high in _ranges(flush):
            yield 0, ANSWERS, number, press(source[low:high]), press(position[low:high]), values[low:high].tobytes()

    return lambda batches: _batches(rows(batches), 16)


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _log_discounted(counts: np.ndarray, discount: np.ndarray) -> np.ndarray:
    """Logarithms of counts from 1 on, discounted."""
    small = np.log10(np.append(discount, 1.0))
    return np.log10(counts) + small[np.minimum(counts, LARGEST + 1) - 1]


def _collect(model: Model, frequent: Frequent, passes: int):
    """All counts and answers of some flushes of texts, as one row per text."""

    def values(n3: np.ndarray, n2: np.ndarray, n1: np.ndarray, is_end: np.ndarray, answers: np.ndarray) -> np.ndarray:
        """What each triple adds to a score."""
        # Every pair but the one that ends a text is the history of the next word: its count is a denominator.
        result = np.where(is_end, 0.0, -np.log10(n2 + 1.0))
        seen = n3 > 0
        result[seen] += _log_discounted(n3[seen], model.triple)
        result[~seen] += answers[~seen]
        lower, lowest = ~seen & (n2 > 0), ~seen & (n2 == 0)
        result[lower] += _log_discounted(n2[lower], model.pair)
        known, unknown = lowest & (n1 > 0), lowest & (n1 == 0)
        result[known] += _log_discounted(n1[known], model.word) - math.log10(model.tokens + 1)
        result[unknown] += math.log10(model.unknown)
        return result

    def sums_of(events: list[bytes], counted: list[tuple], answered: list[list], texts: int) -> tuple[np.ndarray, ...]:
        """Score, base score and known tokens of some of the events of each text."""
        if not counted:
            return np.zeros((3, texts))
        text, times, triple_runs, pair_runs, word_runs = map(unpress, events[:5])
        n3, n2, n1 = ([unpress(cells[i]) for _, cells in counted] for i in range(3))
        begins = dict(zip([bucket for bucket, _ in counted], np.cumsum([0, *map(len, n3)])))
        n3, n2, n1 = map(np.concatenate, (n3, n2, n1))
        answers = np.zeros(len(n3))
        for source, position, cell, *_ in answered:
            found, place = np.unique(unpress(source), return_inverse=True)
            answers[np.array([begins[b] for b in found.tolist()])[place] + unpress(position)] = np.frombuffer(cell)
        is_end = np.unpackbits(np.frombuffer(events[5], np.uint8), count=len(n1)).astype(bool)
        n1, is_end = np.repeat(np.repeat(n1, word_runs), pair_runs), np.repeat(np.repeat(is_end, word_runs), pair_runs)
        value = values(n3, np.repeat(n2, pair_runs), n1, is_end, answers)
        return np.array([np.bincount(text, times * np.repeat(x, triple_runs), texts) for x in (value, np.log10(n1 + 1.0), n1 > 0)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, counted, answered = {}, {}, {}
        for bucket, kind, flush, *cells in _rows(batches):
            if kind == TEXTS:
                texts.setdefault(flush // passes, []).append((flush, cells))
            elif kind == COUNTS:
                counted.setdefault(flush, {})[bucket] = cells
            else:
                answered.setdefault(flush, []).append(cells)
        for same_texts in texts.values():
            ids, known, held, lengths = same_texts[0][1][:4]
            lengths = unpress(lengths)
            sums = np.zeros((3, len(lengths)))
            for flush, cells in same_texts:
                sums += sums_of(cells[4:10], sorted(counted.pop(flush, {}).items()), answered.pop(flush, []), len(lengths))
            score, base, known_tokens = sums
            score -= math.log10(frequent.texts + 1)  # the denominator of a text's first token
            base -= lengths * math.log10(model.tokens + model.vocabulary + 1)
            known, held = (np.unpackbits(np.frombuffer(x, np.uint8), count=len(lengths)).astype(bool) for x in (known, held))
            columns = [
                pa.array(np.frombuffer(ids, np.int64), mask=~known), pa.array(held), pa.array(lengths), pa.array(known_tokens.astype(np.int64)),
                pa.array(np.full(len(lengths), model.tokens, np.int64)), pa.array(base + 0.0), pa.array(score + 0.0),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCORES.split(", ")])

    return run


def _model(tables: DataFrame, frequent: Frequent) -> Model:
    """The corpus-wide numbers, added up in Spark, and those of the frequent words."""
    numbers = np.zeros(3 * LARGEST + 5, np.int64)
    for r in tables.where(F.col("kind") == NUMBERS).groupBy("bucket").agg(F.sum("flush").alias("n")).collect():  # one row per number
        numbers[r.bucket] = r.n
    counts = frequent.of_tokens
    return Model(numbers + np.concatenate([np.zeros(2 * LARGEST + 2, np.int64), _classes(counts), [counts.sum(), (counts > 0).sum()]]))


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = {}
    for number, kind, _, cell, *_ in _rows(batches):
        sums[number] = sums.get(number, 0) + np.frombuffer(cell, np.int64)
    yield from _batches((number, FREQUENT, 0, cell.tobytes()) for number, cell in sums.items())


def _frequent_weights(tables: DataFrame, model: Model, frequent: Frequent, buckets: int) -> np.ndarray:
    """Backoff weights of the frequent words as histories, from numbers added up in Spark (one row for ``_ROWFUL`` words)."""
    rowfuls = -(-len(frequent.words) // _ROWFUL)
    parts = tables.where(F.col("kind") == FREQUENT).repartitionById(min(rowfuls, buckets), F.col("bucket") % min(rowfuls, buckets))
    numbers = np.zeros((_OF_HISTORY, len(frequent.words)), np.int64)
    for r in parts.mapInArrow(_added, _ROW).select("bucket", "c0").collect():
        at = slice(r.bucket * _ROWFUL, (r.bucket + 1) * _ROWFUL)
        numbers[:, at] = np.frombuffer(r.c0, np.int64).reshape(_OF_HISTORY, -1)
    return np.log10(model.backoff(numbers[:-1], numbers[-1]))


def _dealt(rows: DataFrame, buckets: int, passes: int) -> DataFrame:
    """The ranges of one pass, one to a task."""
    return rows.repartitionById(-(-buckets // passes), F.floor(F.col("bucket") / passes).cast("int"))


def _counted(picked: DataFrame, buckets: int, frequent: Frequent, path: str, passes: int) -> DataFrame | None:
    """The tables of the first step; none if the texts were not the same in every pass."""
    spark = picked.sparkSession
    for k in range(passes):
        sent = picked.mapInArrow(_send_triples(buckets, frequent, k, passes), _ROW)
        _dealt(sent, buckets, passes).mapInArrow(_count_triples(buckets, frequent), _ROW).write.mode("append").partitionBy("kind").parquet(path)
    tables = spark.read.schema(_ROW).parquet(path).select(*_NAMES)
    if passes > 1:
        flush = F.floor(F.col("flush") / passes)
        found = tables.where(F.col("kind") == TEXTS).groupBy(flush).agg(F.count("*").alias("n"), F.count_distinct(_CELLS[-1]).alias("different"))
        if not found.where((F.col("n") != passes) | (F.col("different") != 1)).isEmpty():
            return None
    return tables


def score_texts(docs: DataFrame, held_out) -> DataFrame:
    """Train on the rows where ``held_out`` is false (or null) and score every row.

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: one row per row of ``docs``; a null text is empty, that is, one end
    token. Repeated rows count each; null ids stay null; other columns are not read. An empty table gives no rows; without
    training rows every token is the unknown word, with probability 1.
    """
    spark = docs.sparkSession
    size = text_bytes(docs)
    buckets = max(1, -(-size // _BUCKET_BYTES))
    path = scratch_path(spark, "katz")
    picked = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"),
        F.col("text").cast("binary").alias("text"),
    )
    with shuffles_dropped(spark):
        frequent = frequent_words(picked, buckets, size)
        passes = min(_PASSES, buckets)
        tables = _counted(picked, buckets, frequent, f"{path}/counted", passes)
        if tables is None:
            passes = 1
            tables = _counted(picked, buckets, frequent, f"{path}/counted-again", passes)
        model = _model(tables, frequent)
        weights = _frequent_weights(tables, model, frequent, buckets)
        by_history = tables.where(F.col("kind").isin(HISTORIES, LONG_HISTORIES, REQUESTS))
        rounds = min(_HISTORY_PASSES, buckets)
        for k in range(rounds):
            own = by_history.where(F.col("bucket") % rounds == k)
            _dealt(own, buckets, rounds).mapInArrow(_answer(model, frequent, weights), _ROW).write.mode("append").parquet(f"{path}/answers")
    answers = spark.read.schema(_ROW).parquet(f"{path}/answers")
    back = tables.where(F.col("kind").isin(TEXTS, COUNTS)).unionByName(answers)
    home = F.pmod(F.xxhash64(F.floor(F.col("flush") / passes)), F.lit(buckets)).cast("int")
    return back.repartitionById(buckets, home).mapInArrow(_collect(model, frequent, passes), _SCORES)


def op2_katz(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
