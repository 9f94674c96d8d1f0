"""Near duplicates against brute force over all pairs."""

import random

import pytest

from marketframe.llm import neardup
from marketframe.llm.components import components


def sets_of(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_force(rows, percent=85):
    sets = {i: sets_of(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for x in ids:
        for y in ids:
            if x < y:
                shared = len(sets[x] & sets[y])
                if 100 * shared >= percent * (len(sets[x]) + len(sets[y]) - shared):
                    a, b = find(x), find(y)
                    root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed, families=12):
    """Families of near copies at many distances, exact copies, shared passages, short and empty texts."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    texts = [None, "", "  \n", "one", "One", "one two", "ONE two", "a b c d e", "A b c d e", "a b c d e f", "x " * 40]
    for _ in range(families):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([6, 30, 120, 300]))]
        if rnd.random() < 0.5:
            base = base + passage
        for _ in range(rnd.randint(1, 14)):
            copy = list(base)
            for _ in range(int(len(copy) * rnd.choice([0, 0, 0.01, 0.02, 0.03, 0.05]))):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            texts.append(rnd.choice([" ", "\n"]).join(copy))
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "list_rows", "block_rows"), [(1, 64, 256), (2, 1, 3), (3, 2, 1), (4, 4, 1000)])
def test_components_equal_brute_force(spark, seed, list_rows, block_rows):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, component_id string, sketch int")
    found = neardup.near_duplicates(docs, list_rows=list_rows, block_rows=block_rows).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_force(rows)


@pytest.mark.parametrize(("percent", "list_rows"), [(40, 64), (57, 2), (85, 4)])
def test_exact_setting_loses_no_link_at_any_similarity(spark, percent, list_rows):
    rnd = random.Random(percent)
    base = [f"u{i}" for i in range(104)]
    # Nested sets of 10 to 100 shingles: similarities of every degree, ties with the bound among them.
    rows = corpus(9, families=6) + [(1000 + n, " ".join(base[: 4 + n])) for n in range(10, 101, 5)]
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_duplicates(docs, percent, list_rows=list_rows, block_rows=3, exact=True).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_force(rows, percent)


def test_empty_table_null_ids_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert neardup.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    text = " ".join(f"v{i}" for i in range(50))
    rows = [(None, text), (7, text), (7, text), (5, text), (9, None), (3, text + " end")]
    found = sorted(neardup.near_duplicates(spark.createDataFrame(rows, schema)).collect(), key=str)
    by_id = [(r.doc_id, r.component_id) for r in found]
    assert sorted(by_id, key=str) == sorted([(None, None), (7, 3), (7, 3), (5, 3), (9, 9), (3, 3)], key=str)


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(500, 500), (None, 3), (7, 100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(got.values()) == {0} and set(got) == {*range(1, 41), *range(100, 130)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
