"""The Merkle manifest against trees built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from marketframe.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree int, place string, digest int, run string"
LOWER = str.maketrans(merkle._UPPER, merkle._UPPER.lower())


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, width):
    """The root, and for every leaf the runs it passes as (left siblings, right siblings)."""
    under, paths = [[i] for i in range(len(nodes))], [[] for _ in nodes]
    while len(nodes) > 1:
        parents, below = [], []
        for low in range(0, len(nodes), width):
            run = nodes[low : low + width]
            for j in range(len(run)):
                for i in under[low + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            parents.append(h("".join(run)))
            below.append([i for group in under[low : low + width] for i in group])
        nodes, under = parents, below
    return nodes[0], paths


def expected(rows, width=merkle.WIDTH):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    built = []
    for name in names:
        ordered = sorted(sources[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built.append((ordered, *climb([leaf(r) for r in ordered], width)))
    root, upper = climb([b[1] for b in built], width) if built else (None, [])
    out = []
    for (ordered, subroot, paths), above in zip(built, upper):
        for row, path in zip(ordered, paths):
            folded, text = leaf(row), row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                folded = leaf((*row[:4], text.translate(LOWER) if text is not None else None))
            for left, right in path + above:
                folded = h(left + folded + right)
            proof = h("".join(a + b for a, b in path + above))
            out.append((row[0], leaf(row), subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def found(spark, path, rows, width=merkle.WIDTH):
    frame = spark.createDataFrame([(*r, 1, "p", 2, "r") for r in rows], SCHEMA)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    built = merkle.build(frame, path("manifest"), width, tampered)
    return sorted((tuple(r) for r in merkle.verified(merkle.proofs(built)).collect()), key=repr)


def sample():
    rows = [(i, "hot" if i % 3 else f"s{i % 20}", "en", i, f"Text {i} É\nB") for i in range(0, 330)]
    rows += [(i, None, None, None, None) for i in range(500, 517)]  # a last run of one
    rows += [(None, "hot", "de", 3, "no id"), (None, None, None, None, ""), (7, "hot", "en", 1, "")]
    rows += [(900, "twice", "en", 4, "Same"), (900, "twice", "en", 4, "Same"), (900, "twice", "en", 4, "other")]
    return rows + [(901, "lone", "fr", 9, "x" * 100_000 + "Ü"), (902, "", "fr", 0, "-")]


@pytest.mark.parametrize("width", [2, 3, 16])
def test_equal_to_a_plain_tree(spark, path, width):
    assert found(spark, path, sample(), width) == expected(sample(), width)


def test_small_tables(spark, path):
    one = [(1, "a", "en", 2, "Hi")]
    assert found(spark, lambda n: path("one"), one) == expected(one)
    assert found(spark, lambda n: path("none"), []) == []


def test_levels_are_stored_and_a_changed_row_changes_the_root(spark, path):
    rows = [(i, "a", "en", 1, f"t{i}") for i in range(300)]
    frame = spark.createDataFrame([(*r, 1, "p", 2, "r") for r in rows], SCHEMA)
    built = merkle.build(frame, path("m"))
    assert [level.count() for level in built.sources] == [300, 19, 2, 1]
    root = {bytes(r.root) for r in merkle.proofs(built).select("root").distinct().collect()}
    changed = frame.withColumn("text", F.when(F.col("doc_id") == 77, "other").otherwise(F.col("text")))
    other = {bytes(r.root) for r in merkle.proofs(merkle.build(changed, path("n"))).select("root").distinct().collect()}
    assert len(root) == len(other) == 1 and root != other


def test_rejects_a_run_of_one(spark, path):
    with pytest.raises(ValueError, match="at least two"):
        merkle.build(spark.createDataFrame([], SCHEMA), path("m"), 1)
