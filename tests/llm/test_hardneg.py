"""Cover-tree negatives against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketframe.llm import hardneg

SCHEMA = "vec_id long, embedding array<double>, label int, block string, side string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y") for i, v, label in rows], SCHEMA)


def exact(rows, step, positives=5, negatives=3, least=50, most=95):
    usable = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        one = (label, [int(np.floor(256 * x)) for x in v])
        usable[i] = min(usable.get(i, one), one)
    out = []
    for a, (label, q) in usable.items():
        if a % step:
            continue
        scored = [(-sum(x * y for x, y in zip(q, v)), i, own) for i, (own, v) in usable.items() if i != a and len(v) == len(q)]
        for p, i, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            fits = sorted(s for s in scored if s[2] != label and least * -p <= 100 * -s[0] <= most * -p)
            out += [(a, i, rank, j, -p, -n) for rank, (n, j, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, step, **options):
    frame = hardneg.whole_numbers(table(spark, rows).repartition(3), F.col("label"))
    return sorted(tuple(r) for r in hardneg.mine(frame, F.col("vec_id") % step == 0, **options).collect())


def clustered(count, size, seed):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, size))
    return [
        (i, (middles[i % 12] * rng.uniform(0.5, 1.5) + rng.normal(size=size) * 0.2).tolist(), int(rng.integers(0, 4))) for i in range(count)
    ]


@pytest.mark.parametrize("block_rows", [37, 2048])
def test_equal_to_all_pairs(spark, block_rows):
    rows = clustered(500, 8, 3)
    rows += [(1000 + i, [0.5] * 8, i % 2) for i in range(300)]  # a vector that many rows share
    rows += [(2000, [0.0] * 8, 1), (2010, [0.0] * 8, 2), (2020, [-1.0] * 8, 3)]
    expected = exact(rows, 10)
    assert len(expected) > 500
    assert mined(spark, rows, 10, block_rows=block_rows) == expected


def test_other_numbers_and_random_directions(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).tolist(), int(rng.integers(0, 3))) for i in range(200)]
    options = {"positives": 2, "negatives": 7, "least": 10, "most": 100}
    assert mined(spark, rows, 7, **options) == exact(rows, 7, **options)


def test_unusable_rows_repeated_ids_and_lengths(spark):
    rows = clustered(80, 4, 5)
    rows += [
        (100, None, 1), (110, [1.0, None, 0.0, 0.0], 1), (120, [float("nan"), 1.0, 1.0, 1.0], 1), (130, [float("inf")] * 4, 1),
        (140, [1.0] * 4, None), (None, [1.0] * 4, 1), (150, [1.0, 2.0], 1), (160, [2.0, 2.0], 1), (170, [1.5, 1.0], 2), (180, [], 1), (190, [], 2),
        (200, [], 1),
    ]
    rows += [rows[0], (10, [9.0] * 4, 0), (10, [9.0] * 4, 3)]
    assert mined(spark, rows, 10, block_rows=16) == exact(rows, 10)


def test_large_numbers_stay_exact_and_too_large_ones_raise(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=4) * 2e6).round(3).tolist(), i % 2) for i in range(60)]
    assert mined(spark, rows, 5) == exact(rows, 5)
    with pytest.raises(ArithmeticError, match="64 bits"):
        mined(spark, [*rows, (99, [1e300] * 4, 1)], 5)


def test_small_tables(spark):
    assert mined(spark, [], 1) == []
    assert mined(spark, [(0, [1.0], 1)], 1) == []
    pair = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.8], 2)]
    assert mined(spark, pair, 1) == exact(pair, 1)


def test_bounds_hold_and_levels_cover(spark):
    rng = np.random.default_rng(7)
    rows = (rng.normal(size=(400, 5)) * 100).astype(np.int64)
    space = hardneg.Space(float(np.sqrt((rows**2).sum(1).max())) * (1 + 1e-12), np.float64)
    chosen, level, parent, radii, leaf = hardneg.CoverTree.grow(space, rows, 4)
    assert level[0] == 0 and (np.diff(level) >= 0).all() and len(chosen) > 50
    tree = hardneg.CoverTree(space, rows, level, parent, radii, chosen, leaf)
    lifted = space.lift(rows)
    under = {j: set(tree.order[tree.starts[j] : tree.starts[j + 1]].tolist()) for j in range(len(chosen))}
    queries = rng.integers(-100, 100, (7, 5))
    bounds = tree.bounds(queries)
    for number in range(tree.last, -1, -1):
        if number < tree.last:
            under = {j: set().union(*(under[k] for k in tree.children[number][j])) for j in range(len(tree.children[number]))}
        assert set().union(*under.values()) == set(range(400))
        for j, held in under.items():
            held = sorted(held)
            if held:
                assert space.apart(lifted[held], lifted[chosen[j]]).max() <= tree.radii[number, j] * (1 + 1e-9)
                scores = queries @ rows[held].T
                assert (bounds[number][0][:, j] <= scores.min(1)).all() and (scores.max(1) <= bounds[number][1][:, j]).all()
