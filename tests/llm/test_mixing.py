"""Mixing against direct apportionment in Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from marketframe.llm import mixing


def highest_quotients(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max((k for k in votes if votes[k] > 0), key=lambda k: (votes[k] / (2 * won[k] + 1), -k), default=None)
        if best is None:
            break
        won[best] += 1
    return won


@pytest.mark.parametrize("seed", range(4))
def test_seats_go_to_the_highest_quotients(spark, seed):
    rnd = random.Random(seed)
    rows, expected = [], {}
    for group in range(6):
        votes = {k: float(rnd.choice([0, 1, 1, 3, 7, rnd.randint(1, 500)])) for k in range(rnd.choice([1, 2, 9, 30]))}
        seats = rnd.choice([0, 1, 5, 40, 333])
        rows += [(group, k, v, seats) for k, v in votes.items()]
        expected.update({(group, k): n for k, n in highest_quotients(votes, seats).items()})
    frame = spark.createDataFrame(rows, "g int, k int, votes double, total long")
    got = {(r.g, r.k): r.seats for r in mixing.sainte_lague(frame, "k", "g").collect()}
    assert got == expected


def targets_of(sizes):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(order)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            target.update({s: left * weight[s] / total for s in free})
            break
        target.update({s: 2.0 * sizes[s] for s in over})
        left -= sum(2.0 * sizes[s] for s in over)
        free -= over
    return target


def corpus(seed):
    rnd = random.Random(seed)
    rows = [(None, None, None), (1, "", "b"), (1, "", "b"), (2, "one", None), (3, "x y z " * 5000, "a")]
    for i in range(4, 400):
        source = rnd.choice(["a"] * 8 + ["b", "c", "é", "Z", None])
        rows.append((i, " ".join("w" * rnd.randint(1, 4) for _ in range(rnd.randint(0, 200))), source))
    return rows + rows[50:60]


def test_targets_sizes_and_words_taken(spark):
    rows = corpus(3)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, shard int")
    sizes, size_of = {}, {}
    for i, t, s in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes[s] = sizes.get(s, 0) + n
        size_of[i] = n
    target = targets_of(sizes)
    plan = mixing.plan(docs, shard_words=2000)
    source = {i: s for i, _, s in rows}
    got = plan.collect()
    assert len(got) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size_of[r.doc_id], sizes[s])
        assert r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s, goal in target.items():
        assert abs(taken[s] - goal) <= 0.01 * goal + 16 * (1 + sizes[s] / 2000)
    again = mixing.plan(docs.repartition(7), shard_words=2000)
    key = ["doc_id", "size", "target", "taken"]
    assert sorted(map(str, again.select(*key).collect())) == sorted(map(str, plan.select(*key).collect()))


def test_mixed_texts_hold_the_words_taken(spark):
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {}
    for r in mixing.plan(docs).collect():
        taken.setdefault(r.doc_id, []).append(r.taken)
    got = {}
    for r in mixing.mix(docs, ["doc_id", "text", "source"]).collect():
        got.setdefault(r.doc_id, []).append(len(r.text.split()))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(t for t in v if t) for k, v in taken.items() if any(v)}


def test_empty_table_and_texts_without_words(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.plan(spark.createDataFrame([], schema)).collect() == []
    got = mixing.plan(spark.createDataFrame([(1, " ", "a"), (2, None, None)], schema)).select("size", "target", "taken").collect()
    assert [tuple(r) for r in got] == [(0, 0.0, 0)] * 2
    assert mixing.mix(spark.createDataFrame([(1, "\n", "a")], schema), ["text"]).agg(F.count("*")).first()[0] == 0
