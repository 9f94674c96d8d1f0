"""A Merkle manifest of a dataset: one tree per source over its rows in id order, and one tree over the sources' roots.

A level is a table of nodes numbered from 0 within their tree. Consecutive nodes form runs of ``width``; a node's siblings are the other
slots of its run, so their numbers are computed, not searched: with width 2 the sibling of node ``i`` is ``i XOR 1``, with more it is the run's first
number plus every other slot. Each level joins its nodes with these numbers by equality, and the rows of slot zero, which then hold the digests of
their whole run, emit the parents. A join key is one node of one tree, so a source that holds most rows is spread like any other.

The sibling digests are kept per level. Going down again, each node's path is its own siblings followed by the path of its parent; a run
shares the path of its parent, so above the leaves there is one path for ``width`` of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.operators.ordered import ordinal_rank
from marketframe.session import scratch_path

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WIDTH = 16
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TOP = ""


def digest_of(*parts: Column) -> Column:
    """H of the concatenated parts, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def as_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def joined_text(digests: Column) -> Column:
    """Digests as hex text, one behind the other; empty for none."""
    return F.array_join(F.transform(digests, as_text), "")


def row_digest(fields: Sequence[Column]) -> Column:
    """H of a row: each field as ``-`` if null, else its length in bytes, a colon and the value as text."""

    def told(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest_of(*[told(f) for f in fields])


def folded_case(text: Column) -> Column:
    """The tampering the check applies: A-Z in lower case, everything else as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


@dataclass(frozen=True)
class Manifest:
    """Stored levels, leaves first, of the sources' trees and of the tree over their roots; ``subroots`` names the latter's leaves."""

    width: int
    sources: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def with_siblings(level: DataFrame, width: int, keep: Sequence[str] = ()) -> DataFrame:
    """``(tree, run, slot, size, digest, keep..., before, after)``: every node with the digests of its run's other nodes, left and right of it."""
    run, slot = F.expr(f"place div {width}"), (F.col("place") % width).cast("int")
    nodes = level.select("tree", run.alias("run"), slot.alias("slot"), "size", "digest", *keep)
    there = F.least(F.lit(width), F.col("size") - F.col("run") * width).cast("int")
    if width == 2:
        other = F.filter(F.array(F.col("slot").bitwiseXOR(1)), lambda s: s < there)
    else:
        other = F.filter(F.sequence(F.lit(0), there - 1), lambda s: s != F.col("slot"))
    asks = nodes.select("tree", "run", "slot", F.explode(other).alias("at"))
    asks = asks.select("tree", "run", "slot", "at", (F.col("run") * width + F.col("at")).alias("sibling"))
    answers = level.select("tree", F.col("place").alias("sibling"), "digest")
    found = asks.join(answers, ["tree", "sibling"])
    own = F.struct("size", "digest", *keep)
    # Answers and own rows meet by run, so that runs are whole in a task and the parent's path can join them without another shuffle.
    rows = found.select("tree", "run", "slot", F.struct("at", "digest").alias("pair")).withColumn(
        "own", F.lit(None).cast(nodes.select(own.alias("own")).schema["own"].dataType)
    ).unionByName(nodes.select("tree", "run", "slot", own.alias("own")), allowMissingColumns=True)
    pairs = F.array_sort(F.collect_list("pair"))
    grouped = rows.repartition("tree", "run").groupBy("tree", "run", "slot").agg(
        pairs.alias("pairs"), F.first("own", ignorenulls=True).alias("own")
    )

    def side(which) -> Column:
        return F.transform(F.filter("pairs", which), lambda p: p["digest"])

    return grouped.select(
        "tree", "run", "slot", "own.*",
        side(lambda p: p["at"] < F.col("slot")).alias("before"), side(lambda p: p["at"] > F.col("slot")).alias("after"),
    )


def _climb(leaves: DataFrame, width: int, folder: str, keep: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels from the leaves up, and ``(tree, digest)`` of the roots. A tree ends at the level where one node is left."""
    levels, roots, nodes = [], [], leaves
    most = leaves.agg(F.max("size")).first()[0] or 0
    while True:
        level = _stored(with_siblings(nodes, width, () if levels else keep), f"{folder}/level{len(levels)}")
        levels.append(level)
        roots.append(level.where("size = 1").select("tree", "digest"))
        if most <= 1:
            break
        parent = digest_of(as_text(F.col("digest")), joined_text(F.col("after")))
        nodes = level.where("slot = 0 AND size > 1").select(
            "tree", F.col("run").alias("place"), F.ceil(F.col("size") / width).cast("long").alias("size"), parent.alias("digest")
        )
        most = math.ceil(most / width)
    every = roots[0]
    for more in roots[1:]:
        every = every.unionByName(more)
    return levels, every


def build(docs: DataFrame, folder: str, width: int = WIDTH, tampered: Column | None = None, fields: Sequence[str] = FIELDS) -> Manifest:
    """The manifest of ``docs``, stored below ``folder``, which every executor must reach.

    The first two of ``fields`` are id and source. Within a source rows ascend by id, null ids first, equal ids by digest; sources ascend bytewise,
    null first. Rows repeated in full are leaves of their own. ``tampered`` tells which rows get a second digest, with the last field folded.
    Other columns are not read; a null field is told from an empty one; an empty table gives empty levels and no root.
    """
    if width < 2:
        raise ValueError("a run needs at least two nodes")
    row = [F.col(f"`{f}`") for f in fields]
    tree = F.coalesce(F.concat(F.lit(":"), row[1].cast("string")), F.lit("-"))  # null sorts before every source
    altered = F.lit(None).cast("binary")
    if tampered is not None:
        altered = F.when(tampered, row_digest([*row[:-1], folded_case(row[-1])]))
    leaves = _stored(
        docs.select(row[0].alias("doc_id"), tree.alias("tree"), row_digest(row).alias("digest"), altered.alias("altered"))
        .withColumn("row", F.monotonically_increasing_id()),  # tells repeated rows apart, so that they too can be split
        f"{folder}/leaves",
    )
    ranked = ordinal_rank(leaves, ["doc_id", "digest", "row"], "place", by=["tree"], total="size")
    placed = ranked.select("tree", (F.col("place") - 1).alias("place"), "size", "digest", "doc_id", "altered")
    sources, subroots = _climb(placed, width, f"{folder}/sources", ["doc_id", "altered"])
    named = ordinal_rank(subroots, ["tree"], "place").withColumn("place", F.col("place") - 1)
    named = _stored(named, f"{folder}/subroots")
    count = named.count()
    top, _ = _climb(
        named.select(F.lit(_TOP).alias("tree"), "place", F.lit(count).cast("long").alias("size"), "digest"), width, f"{folder}/top"
    )
    return Manifest(width, sources, top, named)


def _descend(levels: list[DataFrame], width: int, roots: DataFrame, carry: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``(tree, place, digest, keep..., path, carry...)`` of the lowest level's nodes; ``roots`` has ``(tree, path, carry...)`` above each tree."""
    paths = None
    for number in range(len(levels) - 1, -1, -1):
        extra = keep if number == 0 else ()
        here = levels[number].withColumn("place", F.col("run") * width + F.col("slot"))
        found = here.where("size = 1").join(roots, "tree").select("tree", "place", "digest", *extra, "path", *carry)
        if paths is not None:
            above = paths.select("tree", F.col("place").alias("run"), F.col("path").alias("above"), *carry)
            own = F.array(F.struct("before", "after"))
            inner = here.where("size > 1").join(above, ["tree", "run"])
            found = found.unionByName(
                inner.select("tree", "place", "digest", *extra, F.concat(own, "above").alias("path"), *carry)
            )
        paths = found
    return paths


def proofs(manifest: Manifest) -> DataFrame:
    """``(doc_id, leaf, altered, subroot, root, path)`` per row: ``path`` holds the sibling digests of every level up to the root, left and right."""
    top = manifest.top[-1]
    step = "array<struct<before:array<binary>,after:array<binary>>>"
    start = top.where("size = 1").select("tree", F.array().cast(step).alias("path"), F.col("digest").alias("root"))
    upper = _descend(manifest.top, manifest.width, start, ["root"])
    roots = manifest.subroots.join(upper.select("place", "path", "root"), "place").select(
        "tree", "path", F.col("digest").alias("subroot"), "root"
    )
    found = _descend(manifest.sources, manifest.width, roots, ["subroot", "root"], ["doc_id", "altered"])
    return found.select("doc_id", F.col("digest").alias("leaf"), "altered", "subroot", "root", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's hex digest and a path give."""
    return F.aggregate(
        path, leaf, lambda d, p: F.sha2(F.concat(joined_text(p["before"]), d, joined_text(p["after"])), 256)
    )


def verified(found: DataFrame) -> DataFrame:
    """The digests as hex text, the digest of each proof, and whether the row as it is now still leads to the root."""
    siblings = F.array_join(F.transform("path", lambda p: F.concat(joined_text(p["before"]), joined_text(p["after"]))), "")
    folded = fold(as_text(F.coalesce("altered", "leaf")), F.col("path"))
    return found.select(
        "doc_id",
        *[as_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return verified(proofs(build(docs, scratch_path(spark, "merkle"), tampered=tampered)))


def merkle_sql(width: int = WIDTH) -> str:
    """The same in DuckDB's SQL; it has no crc32, so the check value is computed bit by bit."""
    told = " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in FIELDS[:-1])
    byte = "list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    crc = (
        "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, "
        f"list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ord(d)::BIGINT)), lambda c, b: {byte}))"
    )

    def told_text(text: str) -> str:
        return f"{told} || coalesce(strlen({text})::VARCHAR || ':' || {text}, '-')"

    def climb(name: str, leaves: str) -> str:
        return f"""
{name}(tree, level, place, n, h) AS (
  SELECT tree, 0, place, n, h FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, place // {width}, (max(n) + {width - 1}) // {width}, sha256(string_agg(h, '' ORDER BY place))
  FROM {name} WHERE n > 1 GROUP BY tree, level, place // {width}),
{name}_sides AS (
  SELECT tree, level, place, n,
    coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, place // {width} ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, place // {width} ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name})"""

    def fold(name: str, start: str, sides: str) -> str:
        return f"""
{name}(k, tree, level, place, acc, proof) AS (
  {start}
  UNION ALL
  SELECT k, f.tree, f.level + 1, f.place // {width}, sha256(l || acc || r), proof || l || r
  FROM {name} f JOIN {sides} s ON s.tree = f.tree AND s.level = f.level AND s.place = f.place WHERE s.n > 1),
{name}_end AS (SELECT k, tree, acc, proof FROM {name} QUALIFY row_number() OVER (PARTITION BY k ORDER BY level DESC) = 1)"""

    return f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce(':' || source, '-') AS tree, sha256({told_text("text")}) AS h,
    CASE WHEN {crc} % 5 = 0 THEN sha256({told_text(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")}) END AS altered
  FROM documents),
leaves AS (SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, h) AS k,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
{climb("up", "leaves")},
subroots AS (SELECT tree AS name, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n, h FROM up WHERE n = 1),
{climb("top", "subroots")},
{fold("low", "SELECT k, tree, 0, place, coalesce(altered, h), '' FROM leaves", "up_sides")},
{fold("high", "SELECT e.k, '', 0, s.place, e.acc, e.proof FROM low_end e JOIN subroots s ON s.name = e.tree", "top_sides")}
SELECT d.doc_id, d.h AS leaf, s.h AS subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.acc AS folded_root, e.acc = t.h AS verified
FROM leaves d JOIN subroots s ON s.name = d.tree JOIN high_end e ON e.k = d.k CROSS JOIN (SELECT h FROM top WHERE n = 1) t
"""
