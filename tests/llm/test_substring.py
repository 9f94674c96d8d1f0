"""Substring dedup against brute force."""

import random

import pytest

from marketframe.llm import substring


def brute_force(rows, width):
    words = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i in sorted(words):
        for at in range(len(words[i]) - width + 1):
            first.setdefault(tuple(words[i][at : at + width]), i)
    result = {}
    for i, own in words.items():
        gone = set()
        for at in range(len(own) - width + 1):
            if first[tuple(own[at : at + width])] < i:
                gone |= set(range(at, at + width))
        result[i] = (len(own), len(gone), b" ".join(w for n, w in enumerate(own) if n not in gone).decode())
    return result


def corpus(seed, width):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["é", "日本", "a,b", "x y"]
    passages = [[rnd.choice(vocabulary) for _ in range(rnd.randint(width - 1, 4 * width))] for _ in range(6)]
    texts = [None, "", " \n ", "a", " ".join(["same"] * 60), " ".join(["same"] * 40), " ".join(passages[0]), " ".join(passages[0])]
    for _ in range(60):
        parts = []
        for _ in range(rnd.randint(1, 5)):
            parts += rnd.choice(passages) if rnd.random() < 0.5 else [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 40))]
        texts.append("".join(w + rnd.choice([" ", "\n", "  ", "\t"]) for w in parts))
    texts += texts[10:20]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "width", "parts", "size"), [(1, 13, 4, 16_000_000), (2, 3, 6, 300), (3, 5, 1, 700)])
def test_words_equal_brute_force(spark, monkeypatch, seed, width, parts, size):
    monkeypatch.setattr(substring, "_BUCKET_BYTES", size)
    rows = corpus(seed, width)
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, bucket string, spans int").repartition(parts)
    found = substring.remove_repeats(docs, ["doc_id", "bucket"], width).collect()
    assert len(found) == len(rows)
    expected = brute_force(rows, width)
    for r in found:
        assert (r.n_words, r.n_removed, r.kept_text) == expected[r.doc_id]
        assert sum(s.end - s.start for s in r.removed) == r.n_removed and r.bucket == "clash"
        assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:]))


def test_text_form_keeps_the_white_space_of_what_stays(spark):
    passage = " ".join(f"p{i}" for i in range(13))
    rows = [(1, passage), (2, f"keep\n this  {passage}\nand\tthat"), (3, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in substring.remove_repeats(docs, ["doc_id"], as_text=True).collect()}
    assert got == {1: passage, 2: "keep\n this  and\tthat", 3: ""}


def test_empty_tables_null_and_repeated_ids(spark):
    schema = "doc_id long, text string"
    assert substring.remove_repeats(spark.createDataFrame([], schema), ["doc_id"]).collect() == []
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text), (5, text), (5, text), (5, "other " + text), (9, text), (2, None)]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring.remove_repeats(spark.createDataFrame(rows, schema), ["doc_id"]).collect())
    assert got == [("2", 0, 0), ("5", 20, 0), ("5", 20, 0), ("5", 21, 0), ("9", 20, 20), ("None", 20, 0)]


def test_names_of_results_cannot_be_kept(spark):
    docs = spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, removed int")
    with pytest.raises(ValueError, match="removed"):
        substring.remove_repeats(docs, ["doc_id", "removed"])
