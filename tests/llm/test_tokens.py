"""The two tokenising operators against the tokenizers library on whole texts."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from marketframe.llm import bpe, tokenfiles

PATH = bpe.vocabulary_path()
HARD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "x\n\ny", "it's  we'll", "!", "\x1c \x1d a", "0 12 3a4", "<|endoftext|>",
    "a<|endoftext|> b", "<|endoftext", "äöü ß éè", "日本語 です", "🙂🙃 🙂", "a b   c", "word," * 50, "a" * 3000, "ab" * 2000,
    " " * 500, "\n " * 200, "the " * 2000, "aaab" * 700 + " x",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def reference(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def random_texts(count):
    rnd = random.Random(7)
    parts = list("aabcdetheins'  \n\tABéñ日🙂12.,!%$") + ["the", "ing", " th", "ation", "<|endoftext|>", "  "]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(3000)][:count]


def test_backtracking_gives_the_merges_of_the_library(library):
    encoder = bpe.backtracking_encoder(PATH)
    for text in [*HARD, *random_texts(3000)]:
        assert np.frombuffer(encoder.encode(text), np.uint32).tolist() == reference(library, text), repr(text)


def test_library_encoder_equals_the_library_on_whole_texts(library):
    texts = [*HARD, *random_texts(1500)]
    found = tokenfiles.library_encoder(PATH).encode_all(texts)
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, np.uint32).tolist() == reference(library, text), repr(text)


def test_a_full_memory_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "_REMEMBERED", 3)
    model = bpe.load(PATH)
    encoder = bpe.TextEncoder(lambda p: model.encode_bytes(p.encode()), model.special, model.specials)
    for text in random_texts(300):
        assert np.frombuffer(encoder.encode(text), np.uint32).tolist() == reference(library, text)


def documents(spark, texts):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")


def test_round_trip_query_columns(spark, library):
    texts = [*HARD, *random_texts(200)]
    rows = {r.doc_id: r for r in bpe.digests(bpe.round_trip(documents(spark, texts), PATH, ["doc_id"])).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        ids = reference(library, text)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bytes_that_are_no_text_are_decoded_like_the_library(spark, library):
    lists = [[i] for i in range(0, 50257, 211)] + [[220, 95, 128], [], None, [50256, 5]]
    frame = spark.createDataFrame(list(enumerate(lists)), "n int, ids array<int>")
    for row in bpe.decode_texts(frame, PATH, ["n"]).collect():
        assert row.decoded == library.decode(lists[row.n] or [], skip_special_tokens=False)


def test_empty_tables(spark, path):
    empty = documents(spark, []).limit(0)
    assert bpe.round_trip(empty, PATH, ["doc_id"]).collect() == []
    manifest = tokenfiles.write_tokens(empty, PATH, path("none"))
    assert manifest.collect() == [] and tokenfiles.read_tokens(manifest).collect() == []


@pytest.mark.parametrize("length", [4, 2048])
def test_files_hold_every_document_in_order(spark, library, path, length):
    texts = [*HARD, *random_texts(300)]
    docs = documents(spark, texts).repartition(5)
    manifest = tokenfiles.write_tokens(docs, PATH, path("tokens"), length)
    got = sorted(tokenfiles.read_tokens(manifest).collect())
    start = 0
    for row, text in zip(got, texts, strict=True):
        ids = [*reference(library, text), 0]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_sequences_and_masks_are_read_by_number(spark, library, path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "_FILE_TOKENS", 500)  # only the driver's copy; a file per task stays possible
    texts = random_texts(400)
    manifest = tokenfiles.write_tokens(documents(spark, texts).coalesce(1), PATH, path("seq"), 16).orderBy("part", "roll").collect()
    stream = [i for t in texts for i in [*reference(library, t), 0]]
    at = 0
    for row in manifest:
        file = tokenfiles.TokenFile(row.tokens_file)
        count = -(-row.n_tokens // 16)
        tokens, masks = zip(*(file.sequence(n) for n in reversed(range(count))))
        flat, mask = np.concatenate(tokens[::-1]), np.concatenate(masks[::-1])
        assert mask.sum() == row.n_tokens and (mask[: row.n_tokens] == 1).all()
        assert flat[: row.n_tokens].tolist() == stream[at : at + row.n_tokens]
        at += row.n_tokens
    assert at == len(stream)


def test_null_and_repeated_ids_keep_their_rows(spark, path):
    rows = [(None, "n"), (3, "b"), (3, "a"), (3, "a"), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = tokenfiles.read_tokens(tokenfiles.write_tokens(docs, PATH, path("odd"))).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 3, 3, 3]
    assert got[2].ids_crc32 == got[3].ids_crc32 != got[4].ids_crc32
