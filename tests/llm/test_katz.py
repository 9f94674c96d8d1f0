"""Scores against the model's definition, evaluated token by token in Python."""

import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marketframe.llm import katz


class Direct:
    def __init__(self, texts):
        self.triples, self.pairs, self.words = Counter(), Counter(), Counter()
        for text in texts:
            tokens = self.tokens_of(text)
            self.words.update(tokens)
            self.pairs.update(zip(["<s>", *tokens], tokens))
            self.triples.update(self.triples_of(tokens))
        self.total = sum(self.words.values())
        self.after, self.after_two = {}, {}
        for (h, w), c in self.pairs.items():
            self.after.setdefault(h, {})[w] = c
        for (h2, h, w), c in self.triples.items():
            self.after_two.setdefault((h2, h), {})[w] = c
        number = lambda counts: [sum(c == r for c in counts.values()) for r in range(1, 7)]
        self.d3, self.d2, self.d1 = (katz.discounts(number(c)) for c in (self.triples, self.pairs, self.words))

    @staticmethod
    def triples_of(tokens):
        return list(zip(["<s>", "<s>", *tokens], ["<s>", *tokens], tokens))

    @staticmethod
    def tokens_of(text):
        return [*(text or "").encode().lower().split(), "</s>"]

    @staticmethod
    def discounted(count, d):
        return count * d[count - 1] if count <= 5 else count

    def word(self, w):
        if w in self.words:
            return self.discounted(self.words[w], self.d1) / (self.total + 1)
        return 1 - sum(self.discounted(c, self.d1) for c in self.words.values()) / (self.total + 1)

    def pair(self, h, w):
        seen = self.after.get(h)
        if not seen:
            return self.word(w)
        whole = sum(seen.values()) + 1
        if w in seen:
            return self.discounted(seen[w], self.d2) / whole
        left = 1 - sum(self.discounted(c, self.d2) for c in seen.values()) / whole
        return left / (1 - sum(self.word(x) for x in seen)) * self.word(w)

    def triple(self, h2, h, w):
        seen = self.after_two.get((h2, h))
        if not seen:
            return self.pair(h, w)
        whole = sum(seen.values()) + 1
        if w in seen:
            return self.discounted(seen[w], self.d3) / whole
        left = 1 - sum(self.discounted(c, self.d3) for c in seen.values()) / whole
        return left / (1 - sum(self.pair(h, x) for x in seen)) * self.pair(h, w)

    def score(self, text):
        return sum(math.log10(self.triple(*t)) for t in self.triples_of(self.tokens_of(text)))

    def base(self, text):
        return sum(math.log10((self.words[t] + 1) / (self.total + 1 * (len(self.words) + 1))) for t in self.tokens_of(text))


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def corpus(seed, count=160):
    rnd = random.Random(seed)
    words = [f"W{i}" for i in range(150)]
    weight = [1 / (i + 1) for i in range(150)]
    texts = [None, "", " ", "W1", "é É W1 w1"]
    texts += [" ".join(rnd.choices(words, weight, k=rnd.randint(1, 60))) for _ in range(count)]
    return list(enumerate(texts + texts[5:20]))


@pytest.mark.parametrize(("seed", "size", "parts", "piece", "most"), [(1, 32_000_000, 3, 24_000_000, 4096), (2, 1500, 4, 900, 4096), (3, 900, 2, 2500, 1)])
def test_scores_follow_the_definition(spark, monkeypatch, seed, size, parts, piece, most):
    monkeypatch.setattr(katz, "_MOST_FREQUENT", most)
    monkeypatch.setattr(katz, "_BUCKET_BYTES", size)
    monkeypatch.setattr(katz, "_SLICE_BYTES", piece)
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, kind string, bucket int").repartition(parts)
    flag = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    found = katz.score_texts(docs, flag).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    direct = Direct([t for i, t in rows if not held(i)])
    for r in found:
        text = texts[r.doc_id]
        tokens = direct.tokens_of(text)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(r.doc_id), len(tokens), direct.total)
        assert r.n_known == sum(direct.words[t] > 0 for t in tokens)
        assert r.base_score == pytest.approx(direct.base(text), abs=1e-9)
        assert r.score == pytest.approx(direct.score(text), abs=1e-9)
    for h in ["<s>", b"w0", b"w149", b"never", next(iter(direct.after))]:
        total = sum(direct.pair(h, w) for w in direct.words) + direct.pair(h, "unknown")
        assert total == pytest.approx(1, abs=1e-12)
    for h2, h in [("<s>", "<s>"), ("<s>", b"w0"), (b"w0", b"w1"), ("never", b"w0"), next(iter(direct.after_two))]:
        total = sum(direct.triple(h2, h, w) for w in direct.words) + direct.triple(h2, h, "unknown")
        assert total == pytest.approx(1, abs=1e-12)


def test_a_frequent_word_is_spread(spark, monkeypatch):
    """A word that is a third of all tokens, and the ends of texts, go to many ranges, and are counted as one."""
    monkeypatch.setattr(katz, "_BUCKET_BYTES", 1000)
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["hot", f"w{rnd.randrange(40)}", f"w{rnd.randrange(400)}"]) for _ in range(40)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    picked = docs.select("doc_id", F.lit(False).alias("held"), F.col("text").cast("binary").alias("text"))
    frequent = katz.frequent_words(picked, 9)
    word = katz.hash_words(*katz.text_buffers(pa.array([b"hot"])), lower=True)[0]
    assert word[0] in frequent.words and katz.END in frequent.words
    neighbours = katz.mix(np.arange(500, dtype=np.uint64))
    assert len(set(katz.bucket_of(frequent.dealt(np.repeat(word, 500), neighbours), 9).tolist())) == 9
    direct = Direct([t for i, t in enumerate(texts) if not held(i)])
    assert frequent.texts == 60
    for r in katz.score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).collect():
        assert r.score == pytest.approx(direct.score(texts[r.doc_id]), abs=1e-9)


def test_held_out_texts_score_better_than_the_base(spark):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not there")
    rows = katz.op2_katz(spark, folder).where("held_out").collect()
    assert len(rows) == sum(held(i) for i in pq.read_table(f"{folder}/documents.parquet")["doc_id"].to_pylist())
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_empty_table_null_ids_and_no_training_rows(spark):
    schema = "doc_id long, text string"
    assert katz.score_texts(spark.createDataFrame([], schema), F.lit(False)).collect() == []
    rows = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], schema)
    got = katz.score_texts(rows, F.lit(None).cast("boolean")).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens) for r in got) == [("1", 1, 1, 7), ("None", 3, 3, 7), ("None", 3, 3, 7)]
    got = katz.score_texts(rows, F.lit(True)).collect()
    assert all((r.base_score, r.score, r.n_known, r.train_tokens) == (0.0, 0.0, 0, 0) for r in got)


def test_discounts_are_good_turing_or_one():
    n = [100, 40, 20, 12, 8, 5]
    d = katz.discounts(n)
    common = 6 * 5 / 100
    assert d[0] == pytest.approx((2 * 40 / 100 - common) / (1 - common))
    assert (katz.discounts([0] * 6) == 1).all() and (katz.discounts([5, 0, 0, 9, 9, 9]) == 1).all()


def test_tables_between_the_steps_stay_small(spark, monkeypatch, tmp_path):
    """Nearly every triple is another one; many ranges must not add a row of sums for each text and range."""
    monkeypatch.setattr(katz, "_BUCKET_BYTES", 40_000)
    monkeypatch.setattr(katz, "scratch_path", lambda spark, label: str(tmp_path / label))
    rnd = random.Random(3)
    weight = [1 / (i + 1) for i in range(3000)]
    texts = [" ".join(f"w{i}" for i in rnd.choices(range(3000), weight, k=300)) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    assert katz.score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).count() == 400
    size = 0
    for file in tmp_path.rglob("*.parquet"):
        for column in pq.ParquetFile(file).read().columns:
            if pa.types.is_binary(column.type):
                size += sum(len(x) for x in column.to_pylist() if x)
    assert size < 15 * 400 * 301


def test_texts_that_come_otherwise_in_the_second_pass(spark, monkeypatch):
    monkeypatch.setattr(katz, "_BUCKET_BYTES", 1000)
    rows = corpus(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    flag = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    expected = {r.doc_id: r for r in katz.score_texts(docs, flag).collect()}
    monkeypatch.setattr(katz, "_digest", lambda *_: os.urandom(16))
    found = {r.doc_id: r for r in katz.score_texts(docs, flag).collect()}
    assert found.keys() == expected.keys()
    for i, r in found.items():
        assert r[:5] == expected[i][:5]
        assert r[5:] == pytest.approx(expected[i][5:], abs=1e-9)


def test_words_and_keys_keep_their_value():
    words = katz.mix(np.arange(1, 500, dtype=np.uint64))
    frequent = katz.Frequent({int(words[0]): 3}, 2, words[:100].tolist())
    assert (frequent.unpack_words(frequent.pack_words(words, frequent.codes(words))) == words).all()
    keys = words & katz._KEY_MASK
    assert (frequent.unpack_words(frequent.pack_words(keys, frequent.key_codes(keys), 6), 6) == keys).all()
    for values in (np.zeros(0, np.int64), np.arange(70000), np.full(1000, 3), np.array([1 << 40])):
        assert (katz.unpress(katz.press(values)) == values).all()
