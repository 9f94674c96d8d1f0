"""Near duplicates by bottom-k sketches of one hash function.

A document's set is its distinct 5-word shingles, hashed once; its sketch is the ``k`` smallest hashes. Equal sets are joined
first by a digest of the whole set, and one of each goes on. Inverted lists of retained values give the candidates: two documents
that are similar enough share at least ``share`` percent of their retained values, so both have one of these in the ``size - share * size / 100 + 1`` of
their values that occur least in the corpus; values of one document alone need no list, and common ones are hardly ever looked at. The
smallest k of a pair's union then estimate its similarity, and pairs that pass are compared on their full sets.

Lists of up to ``list_rows`` documents give their pairs as rows. Documents on longer lists (many near copies, or texts made of common
passages) are joined to groups over those lists, cut into blocks ordered by set size, and compared block against block inside tasks,
which return a spanning set of the links found; so neither pairs nor texts of a group ever meet in one place.

``share`` is 55 for k = 64: a pair at a similarity of 0.85 falls short of it with a probability below 1e-8. With ``exact`` the sketch is the
whole set and ``share`` the similarity asked for, which two linked sets cannot fall short of, so no link is lost; lists then hold every
shingle that two documents have.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.components import components
from marketframe.llm.words import hash_words, rolling, text_buffers
from marketframe.operators.ordered import ordinal_rank
from marketframe.session import scratch_path

SHINGLE = 5
SKETCH = 64
SHARE = 55
_WHOLE = 1 << 30


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; the whole sequence is one shingle when it has fewer words."""
    hashes, _, _, first = hash_words(*text_buffers(texts), lower=True)
    found = []
    for low, high in zip(first[:-1], first[1:]):
        words = hashes[low:high]
        windows = rolling(words, min(width, len(words))) if len(words) else words
        # A short text's only shingle must not equal one of full width.
        found.append(np.unique(windows).view(np.int64) if len(words) >= width else (windows ^ np.uint64(len(words))).view(np.int64))
    for values in found:
        values.sort()
    return found


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def sketches(docs: DataFrame, k: int = SKETCH) -> DataFrame:
    """``(doc_id, n_shingles, digest, sketch)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1))
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            offsets = np.concatenate([[0], np.cumsum([min(len(s), k) for s in sets])]).astype(np.int32)
            values = np.concatenate([s[:k] for s in sets]) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ],
                ["doc_id", "n_shingles", "digest", "sketch"],
            )

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_shingles long, digest binary, sketch array<long>")


def rare_values(firsts: DataFrame, share: int = SHARE) -> DataFrame:
    """``(value, rows, doc_id, n_shingles)``: per document the retained values on which it may meet others."""
    spread = firsts.select("doc_id", "n_shingles", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    shared = spread.groupBy("value").agg(F.count("*").alias("rows")).where("rows > 1")
    known = spread.join(shared, "value").groupBy("doc_id", "n_shingles", "size").agg(
        F.sort_array(F.collect_list(F.struct("rows", "value"))).alias("values")  # at most the sketch size
    )
    # Values of this document alone come first in the order; the rest of the prefix is taken from the shared ones.
    left = F.expr(f"size - (size * {share} + 99) div 100 + 1 - (size - size(values))")
    return (
        known.where(left > 0)
        .select("doc_id", "n_shingles", F.explode(F.slice("values", F.lit(1), left.cast("int"))).alias("v"))
        .select("v.value", "v.rows", "doc_id", "n_shingles")
    )


def _pairs_of_short_lists(lists: DataFrame, percent: int) -> DataFrame:
    """``(a, b)`` with a < b: documents that meet on a short list and whose set sizes allow the similarity."""
    members = lists.groupBy("value").agg(F.sort_array(F.collect_set(F.struct("doc_id", "n_shingles"))).alias("m"))
    ahead = members.where(F.size("m") > 1).select(F.posexplode("m").alias("i", "a"), "m")
    pairs = ahead.select("a", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("b"))
    fits = 100 * F.least("a.n_shingles", "b.n_shingles") >= percent * F.greatest("a.n_shingles", "b.n_shingles")
    return pairs.where(fits & (F.col("a.doc_id") != F.col("b.doc_id"))).select(
        F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b")
    ).distinct()


def _likely(pairs: DataFrame, firsts: DataFrame, k: int, share: int) -> DataFrame:
    """Pairs whose similarity, estimated from the smallest k values of the union of both sketches, is at least ``share`` percent."""
    a = firsts.select(F.col("doc_id").alias("a"), F.col("sketch").alias("sa"))
    b = firsts.select(F.col("doc_id").alias("b"), F.col("sketch").alias("sb"))
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k)
    both = pairs.join(a, "a").join(b, "b").withColumn("u", union)
    common = F.size(F.array_intersect("u", F.array_intersect("sa", "sb")))
    return both.where(100 * common >= share * F.size("u")).select("a", "b")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs that are similar on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = [similar(x, y, percent) for x, y in zip(shingle_sets(batch.column(2)), shingle_sets(batch.column(3)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(links, pa.bool_()))

    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _block_links(percent: int, k: int, share: int):
    """Links between two blocks (or inside one), as a spanning set."""

    def estimate(sketch: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
        # Sketches side by side, shorter ones filled up: the smallest k distinct values, and how many of them come twice.
        width = max(len(o) for o in others)
        filler = np.iinfo(np.int64).max
        table = np.full((len(others), width + len(sketch)), filler)
        for row, other in enumerate(others):
            table[row, : len(other)] = other
        table[:, width:] = sketch
        table.sort(axis=1)
        twice = np.zeros(table.shape, bool)
        twice[:, 1:] = (table[:, 1:] == table[:, :-1]) & (table[:, 1:] != filler)
        rank = np.cumsum(~twice & (table != filler), axis=1)
        inside = rank <= k
        union = np.minimum(rank[:, -1], k)
        return 100 * (twice & inside).sum(axis=1) >= share * union

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids, blocks = table["doc_id"].to_pylist(), table["block"].to_numpy()
        left, right = key[1].as_py(), key[2].as_py()
        sets = shingle_sets(table["text"])
        parent = list(range(len(ids)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        sizes = np.array([len(s) for s in sets])
        rows_left, rows_right = np.flatnonzero(blocks == left), np.flatnonzero(blocks == right)
        found = []
        for i in rows_left:
            others = rows_right[rows_right > i] if left == right else rows_right
            small, large = np.minimum(sizes[i], sizes[others]), np.maximum(sizes[i], sizes[others])
            others = others[100 * small >= percent * large]
            mine = root(i)
            others = [j for j in others if root(j) != mine]
            if not others:
                continue
            for j, likely in zip(others, estimate(sets[i][:k], [sets[j][:k] for j in others])):
                if likely and root(j) != root(i) and similar(sets[i], sets[j], percent):
                    parent[root(j)] = root(i)
                    found.append((ids[i], ids[j]))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return run


def _links_of_long_lists(lists: DataFrame, texts: DataFrame, percent: int, k: int, share: int, block_rows: int) -> DataFrame:
    """Links between documents that meet on long lists."""
    heads = lists.groupBy("value").agg(F.min("doc_id").alias("a"))
    grouped = components(lists.join(heads, "value").select("a", F.col("doc_id").alias("b")))
    members = lists.select("doc_id", "n_shingles").distinct()
    placed = members.join(grouped, members.doc_id == grouped.node, "left").select(
        F.coalesce("component", "doc_id").alias("cluster"), "doc_id", "n_shingles"
    )
    ranked = ordinal_rank(placed, ["n_shingles", "doc_id"], "__rank", by=["cluster"])
    blocks = ranked.select(
        "cluster", "doc_id", "n_shingles", F.expr(f"cast((__rank - 1) div {block_rows} as int)").alias("block")
    )
    spans = blocks.groupBy("cluster", "block").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"))
    other = spans.select("cluster", F.col("block").alias("right"), F.col("low").alias("right_low"))
    # Blocks ascend by set size: a block meets later ones until these are too large.
    meets = spans.withColumnRenamed("block", "left").join(other, "cluster").where(
        f"right >= left AND {percent} * right_low <= 100 * high"
    ).select("cluster", "left", "right")
    sides = meets.select(
        "cluster", "left", "right", F.explode(F.array_distinct(F.array("left", "right"))).alias("block")
    )
    rows = (
        blocks.join(texts, "doc_id")
        .select("cluster", "block", "doc_id", "text")
        .join(sides, ["cluster", "block"])
        .select("cluster", "left", "right", "block", "doc_id", "text")
    )
    return rows.groupBy("cluster", "left", "right").applyInArrow(_block_links(percent, k, share), "a long, b long")


def near_duplicates(
    docs: DataFrame, percent: int = 85, k: int = SKETCH, share: int = SHARE, list_rows: int = 64, block_rows: int = 256,
    exact: bool = False,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``.

    Texts without words have no set and no link; so has a row without id, whose component is null. Ids are taken to be unique:
    rows that repeat an id are judged each by its own set, and get one row each. Columns besides ``doc_id`` and ``text`` are not read.
    ``exact`` replaces ``k`` and ``share`` by what cannot lose a link.
    """
    if exact:
        k, share = _WHOLE, percent
    spark = docs.sparkSession
    path = scratch_path(spark, "sketches")
    sketches(docs, k).write.parquet(path)
    sketched = spark.read.parquet(path)
    classes = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first"))
    firsts = (
        sketched.where("n_shingles > 0")
        .join(classes.select("digest", F.col("first").alias("doc_id")), ["digest", "doc_id"], "left_semi")
        .dropDuplicates(["doc_id", "digest"])
        .select("doc_id", "n_shingles", "sketch")
    )
    lists_path = scratch_path(spark, "lists")
    rare_values(firsts, share).write.parquet(lists_path)
    lists = spark.read.parquet(lists_path)
    short, long = lists.where(F.col("rows") <= list_rows), lists.where(F.col("rows") > list_rows)
    pairs_path, texts_path, links_path = (scratch_path(spark, x) for x in ("pairs", "texts", "links"))
    _likely(_pairs_of_short_lists(short, percent), firsts, k, share).write.parquet(pairs_path)
    pairs = spark.read.parquet(pairs_path)
    # Texts travel once, and only those that are compared are kept.
    wanted = (
        pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).unionByName(long.select("doc_id")).distinct()
    )
    docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")).join(
        wanted, "doc_id", "left_semi"
    ).write.parquet(texts_path)
    texts = spark.read.parquet(texts_path)
    found = _confirmed(pairs, texts, percent).unionByName(_links_of_long_lists(long, texts, percent, k, share, block_rows))
    found.write.parquet(links_path)
    joined = components(spark.read.parquet(links_path))
    roots = classes.join(joined, F.col("first") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "first").alias("root")
    )
    return sketched.join(roots, "digest", "left").select(
        "doc_id", "n_shingles",
        F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("root")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def op9_near_duplicates(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).withColumn("kept", F.col("doc_id") == F.col("component_id"))
