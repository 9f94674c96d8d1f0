"""Language identification against n-gram sets kept in plain Python, and held-out accuracy."""

import os
import zlib
from collections import Counter

import numpy as np
import pytest

from marketframe.llm import langid

SCHEMA = "doc_id long, text string, lang string, __text string, gram string, n int"


def plain_grams(text, widths):
    words = "".join(c if c.isalpha() else " " for c in text).split()
    found = Counter()
    for word in words:
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in word)
        for n in widths:
            edged = f"0{low}0"
            found.update((n, edged[i : i + n]) for i in range(len(edged) - n + 1))
    return found


def plain_model(rows, widths, least=1e-5, share=0.5):
    counts = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(plain_grams(text, widths))
    counts = {lang: c for lang, c in counts.items() if c}
    rates = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    best = {}
    for own in rates.values():
        for g, r in own.items():
            best[g] = max(best.get(g, 0), r)
    order = sorted(counts, key=lambda lang: (-sum(counts[lang].values()), lang))
    return {lang: {g for g, r in rates[lang].items() if r >= least and r >= share * best[g]} for lang in order}


def plain_decision(model, text, widths):
    own = plain_grams(text or "", widths)
    if not own:
        return "und"
    hits = {lang: sum(n for g, n in own.items() if g in known) for lang, known in model.items()}
    return max(hits, key=hits.get)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "a", "b", 1) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)


def identified(spark, rows, filters):
    found = langid.identify(frame(spark, rows), filters, ["doc_id", "__text", "gram"])
    return {r.doc_id: r for r in found.collect()}


def test_grams_are_those_of_plain_python():
    texts = ["Ab, c!", "", "Éa bß\tÇ9z", "1 2 3", "日本 語", "x" * 50, "\n", "İa ǅ"]
    for widths in ((3,), (2, 3), (3, 4), (5, 2)):
        hashes, rows = langid.grams(texts, widths)
        got = [Counter(hashes[rows == i].tolist()) for i in range(len(texts))]
        expected = [plain_grams(t, widths) for t in texts]
        assert [sorted(c.values()) for c in got] == [sorted(c.values()) for c in expected]
    a, b = langid.grams(["The then", "then THE"], (3,))
    assert sorted(a[b == 0].tolist()) == sorted(a[b == 1].tolist())


def test_filters_hold_all_sets_and_predict_their_errors(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(6000)]
    rows = [(" ".join(words[i : i + 50]), f"l{i // 50 % 70:02d}") for i in range(0, 6000, 50)]
    filters = langid.learn(frame(spark, rows), (3, 4))
    model = plain_model(rows, (3, 4))
    assert filters.languages == tuple(model) and filters.table.shape[1] == 2
    unknown = rng.integers(0, 2**64 - 1, 200_000, dtype=np.uint64)
    masks = filters.masks(unknown)
    for i in (0, 1, 64, 69):
        seen = ((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()
        assert seen == pytest.approx(filters.false_positives[i], abs=0.002)


def test_no_gram_of_a_set_is_missed(spark):
    rows = [("alpha beta gamma delta", "x"), ("uno dos tres cuatro", "y"), ("alpha dos", None)]
    filters = langid.learn(frame(spark, rows), (3, 4))
    for i, lang in enumerate(filters.languages):
        text = next(t for t, own in rows if own == lang)
        hashes, _ = langid.grams([text], (3, 4))
        assert (((filters.masks(hashes)[:, 0] >> np.uint64(i)) & np.uint64(1)) == 1).all()


def test_defined_results_for_odd_rows(spark):
    learned = [("the cat sat on the mat and the dog", "en")] * 30 + [("der hund und die katze auf der matte", "de")] * 5 + [(None, "fr"), ("123", "it"), ("words", None)]
    filters = langid.learn(frame(spark, learned))
    assert filters.languages == ("en", "de")
    asked = [
        (None, "en"), ("", "en"), ("12 !?", None), ("The mat", None), ("Der Hund", "en"), ("日本", None), ("a", None),
        ("der hund und " * 200_000, None), ("mat der", None),
    ]
    got = identified(spark, asked, filters)
    assert len(got) == len(asked)
    assert [got[i].lang_pred for i in range(6)] == ["und", "und", "und", "en", "de", "en"]
    assert got[0].score == got[2].score == got[5].score == 0 and got[0].n_grams == 0
    assert got[6].lang_pred in ("en", "de") and got[7].lang_pred == "de"
    # The score is the winner's share of all hits, which the sets of plain Python give but for false positives.
    model, own = plain_model(learned, langid.WIDTHS), plain_grams(asked[7][0], langid.WIDTHS)
    hits = {lang: sum(n for g, n in own.items() if g in known) for lang, known in model.items()}
    assert got[7].score == pytest.approx(hits["de"] / sum(hits.values()), abs=0.02) and got[7].n_grams == sum(own.values())
    assert all(0 <= r.score <= 1 for r in got.values()) and got[3]["__text"] == "a"
    with pytest.raises(ValueError, match="results"):
        langid.identify(frame(spark, asked), filters, ["score"])


def test_nothing_learned_and_empty_tables(spark):
    nothing = langid.learn(frame(spark, [("text", None)]))
    assert nothing.languages == ()
    assert identified(spark, [("text", "en")], nothing)[0].lang_pred == "und"
    filters = langid.learn(frame(spark, [("text", "en")]))
    assert identified(spark, [], filters) == {}


def test_held_out_accuracy_and_agreement_with_plain_sets(spark):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not there")
    docs = {r.doc_id: (r.text, r.lang) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = {i for i in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    model = plain_model([docs[i] for i in docs if i not in out], langid.WIDTHS)
    got = {r.doc_id: r for r in langid.op11_language_id(spark, folder).collect()}
    assert got.keys() == docs.keys() and {i for i, r in got.items() if r.held_out} == out
    assert sum(got[i].lang_pred == docs[i][1] for i in out) >= 0.98 * len(out)
    assert sum(got[i].lang_pred == plain_decision(model, docs[i][0], langid.WIDTHS) for i in docs) >= 0.99 * len(docs)
