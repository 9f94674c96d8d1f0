"""Multi-index hashing against exact search."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketframe.llm import annsearch

SCHEMA = "vec_id long, embedding array<float>, label int, code string, side string"


def exact(vectors, query_ids, k):
    ids = np.array(sorted(vectors))
    table = np.array([vectors[i] for i in ids], np.float64)
    found = {}
    for q in query_ids:
        scores = annsearch.inner(table, np.array(vectors[q], np.float64))
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
        found[q] = [(int(ids[j]), float(scores[j])) for j in order]
    return found


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in vectors], SCHEMA)


def grouped(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


def test_the_index_returns_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 2**64 - 1, 3000, dtype=np.uint64)
    codes[::7] = codes[3] ^ np.uint64(5)
    index = annsearch.SubstringIndex(codes, 64, 4)
    for radius in (0, 3, 11, 24, 30, 64):
        for code in codes[:5]:
            expected = np.flatnonzero(np.bitwise_count(codes ^ code) <= radius)
            assert index.within(code, radius).tolist() == expected.tolist()


def test_recall_on_the_given_vectors_and_exact_scores(spark):
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not there")
    vectors = {r.vec_id: np.array(r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    got = grouped(annsearch.op5_multi_index_hashing(spark, folder).collect())
    expected = exact(vectors, [i for i in vectors if i % 20 == 0], 20)
    assert got.keys() == expected.keys()
    hits = 0
    for q, best in got.items():
        assert len(best) == 20 and q not in dict(best)
        assert best == sorted(best, key=lambda b: (-b[1], b[0]))
        hits += len(dict(best).keys() & dict(expected[q]).keys())
        for i, score in best:
            assert score == pytest.approx(float(np.dot(vectors[i], vectors[q])), abs=1e-12)
    assert hits / (20 * len(got)) >= 0.9


@pytest.mark.parametrize(("block_rows", "query_rows"), [(40, 7), (8192, 1024)])
def test_unequal_norms_copies_and_unusable_vectors(spark, block_rows, query_rows):
    rng = np.random.default_rng(2)
    vectors = [(i, (rng.normal(size=6) * rng.uniform(0.1, 3)).astype(np.float32).tolist()) for i in range(200)]
    vectors += [(i, [1.0, 0.5, 0.0, 0.0, 0.0, 0.25]) for i in range(200, 260)]
    odd = [
        (300, None), (320, [0.0] * 6), (340, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (360, [float("nan")] + [1.0] * 5), (380, [float("inf")] * 6),
        (400, [1.0, 2.0]), (None, [1.0] * 6), (420, []),
    ]
    good = dict(vectors)
    frame = table(spark, vectors + odd + vectors[:3]).repartition(3)
    got = grouped(annsearch.nearest(frame, F.col("vec_id") % 20 == 0, k=20, recall=1.0, block_rows=block_rows, query_rows=query_rows).collect())
    expected = exact(good, [i for i in good if i % 20 == 0], 20)
    assert got.keys() == expected.keys()
    same = sum(got[q] == expected[q] for q in got)
    assert same >= 0.9 * len(got)
    assert [i for i, _ in got[200]] == [i for i, _ in expected[200]]


def test_few_vectors_are_searched_exactly(spark):
    vectors = [(i, [float(i), 1.0, -1.0]) for i in range(6)]
    got = grouped(annsearch.nearest(table(spark, vectors), F.col("vec_id") % 2 == 0, k=20).collect())
    assert got == exact(dict(vectors), [0, 2, 4], 20)
    assert annsearch.nearest(table(spark, vectors[:1]), F.col("vec_id") == 0).collect() == []


def test_empty_table_and_no_queries(spark):
    assert annsearch.nearest(table(spark, []), F.col("vec_id") == 0).collect() == []
    assert annsearch.nearest(table(spark, [(1, [1.0]), (3, [2.0])]), F.col("vec_id") == 0).collect() == []
