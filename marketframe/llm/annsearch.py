"""Nearest neighbours by inner product with multi-index hashing.

Vectors are lengthened by one component so that all have the same norm and larger inner products mean smaller angles, rotated by a
rotation learned on a bounded sample (iterative quantisation), and coded by their signs. A code is split into substrings, each with an
index of its own; if two codes differ in at most r bits, one of m substrings differs in at most r // m (pigeonhole), so probing
every index within that distance finds all codes within r. These are checked in full and ranked by the inner products of the
original vectors. The radius is the smallest that reaches the wanted recall on the sample. A query that
finds fewer than it should within the radius is asked again with no limit, which is an exact search.

Rows and queries are dealt into blocks by hash; every block of queries meets every block of rows in one task, which returns the best of the
block only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketframe.session import scratch_path

SAMPLE = 20_000
SAMPLE_QUERIES = 256


@dataclass(frozen=True)
class Coder:
    """A learned rotation and the radius that reaches the recall on the sample."""

    norm: float
    center: np.ndarray
    rotation: np.ndarray
    radius: int = 0

    @property
    def bits(self) -> int:
        return self.rotation.shape[1]

    def lengthened(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.norm
        rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(1)))
        return np.concatenate([scaled, rest[:, None]], 1)

    def _code(self, lengthened: np.ndarray) -> np.ndarray:
        signs = (lengthened - self.center) @ self.rotation > 0
        packed = np.packbits(signs, axis=1, bitorder="little")
        wide = np.zeros((len(signs), 8), np.uint8)
        wide[:, : packed.shape[1]] = packed
        return wide.view(np.uint64).ravel()

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        return self._code(self.lengthened(vectors))

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.sqrt((vectors * vectors).sum(1))[:, None]
        return self._code(np.concatenate([unit, np.zeros((len(unit), 1))], 1))


def learn(vectors: np.ndarray, norm: float, k: int, recall: float, bits: int = 64, steps: int = 30, seed: int = 5) -> Coder:
    """Principal directions, then a rotation turned step by step toward the signs it gives."""
    rough = Coder(norm, np.zeros(vectors.shape[1] + 1), np.zeros((vectors.shape[1] + 1, 1)))
    lengthened = rough.lengthened(vectors)
    center = lengthened.mean(0)
    moved = lengthened - center
    values, directions = np.linalg.eigh(moved.T @ moved)
    count = min(bits, 64, vectors.shape[1])
    chosen = directions[:, np.argsort(values)[::-1][:count]]
    projected = moved @ chosen
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(count, count)))
    for _ in range(steps):
        u, _, vt = np.linalg.svd(projected.T @ np.where(projected @ turn > 0, 1.0, -1.0))
        turn = u @ vt
    coder = Coder(norm, center, chosen @ turn)

    asked = vectors[np.linspace(0, len(vectors) - 1, min(SAMPLE_QUERIES, len(vectors))).astype(int)]
    scores = asked @ vectors.T
    best = np.argsort(-scores, axis=1, kind="stable")[:, 1 : k + 1]
    if not best.size:
        return Coder(norm, center, coder.rotation, count)
    codes = coder.rows(vectors)
    apart = np.bitwise_count(coder.queries(asked)[:, None] ^ codes[best])
    return Coder(norm, center, coder.rotation, int(np.ceil(np.quantile(apart, recall))))


class SubstringIndex:
    """One table per substring: its values, and the rows that have each."""

    def __init__(self, codes: np.ndarray, bits: int, substrings: int):
        edges = [bits * i // substrings for i in range(substrings + 1)]
        self.codes, self.tables = codes, []
        for low, high in zip(edges[:-1], edges[1:]):
            part = self._part(codes, low, high)
            order = np.argsort(part, kind="stable")
            values, starts = np.unique(part[order], return_index=True)
            self.tables.append((low, high, values, starts, np.diff(np.append(starts, len(codes))), order))

    @staticmethod
    def _part(codes: np.ndarray, low: int, high: int) -> np.ndarray:
        return (codes >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """All rows whose code differs from ``code`` in at most ``radius`` bits."""
        marked = np.zeros(len(self.codes), bool)
        limit = radius // len(self.tables)
        for low, high, values, starts, counts, order in self.tables:
            near = np.flatnonzero(np.bitwise_count(values ^ self._part(code, low, high)) <= limit)
            lengths = counts[near]
            place = np.repeat(starts[near] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
            marked[order[place]] = True
        found = np.flatnonzero(marked)
        return found[np.bitwise_count(self.codes[found] ^ code) <= radius]


def inner(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in the same order wherever its row stands."""
    return (rows * query).sum(axis=1)


_FOUND = "query_id long, vec_id long, score double"


def _search(coder: Coder, k: int, substrings: int, radius: int, dimension: int):
    def run(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        ids = table["vec_id"].to_numpy()
        vectors = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
        rows, asked = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        columns = ([], [], [])
        if len(rows) and len(asked):
            row_ids, row_vectors = ids[rows], vectors[rows]
            index = SubstringIndex(table["code"].to_numpy().view(np.uint64)[rows], coder.bits, substrings)
            codes = coder.queries(vectors[asked])
            for query_id, query, code in zip(ids[asked], vectors[asked], codes):
                near = index.within(code, radius)
                near = near[row_ids[near] != query_id]
                scores = inner(row_vectors[near], query)
                if len(near) > k:
                    reach = np.partition(scores, len(scores) - k)[len(scores) - k]
                    near, scores = near[scores >= reach], scores[scores >= reach]
                best = np.lexsort((row_ids[near], -scores))[:k]
                for column, values in zip(columns, (np.full(len(best), query_id), row_ids[near[best]], scores[best])):
                    column.append(values)
        types = (np.int64, np.int64, np.float64)
        return pa.table({
            name: np.concatenate([np.zeros(0, t), *column])
            for name, column, t in zip(("query_id", "vec_id", "score"), columns, types)
        })

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, vector)``: vectors in double precision, one row per id.

    Left out are null ids and vectors, vectors with null or non-finite components, zero vectors, and those of another length than most
    have (on a tie the larger length stays). Rows that repeat an id count once, with the smallest vector.
    """
    v = F.col("embedding").cast("array<double>")
    bad: Column = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("vector", lambda x: x == 0)
    sound = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("vector")).where(
        "vec_id IS NOT NULL AND vector IS NOT NULL"
    ).where(~bad & ~zero)
    one = sound.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    lengths = one.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return one.where(F.size("vector") == (lengths[0] if lengths else 0))


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, recall: float = 0.98, substrings: int = 4,
    block_rows: int = 8192, query_rows: int = 1024,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for every usable row where ``is_query`` holds.

    Ranks begin at 1, ties go to the smaller id, a query's own row is no candidate. With fewer than ``k`` others, all are returned. A query
    that is not usable gets no row, an empty table gives none. ``is_query`` reads ``vec_id``.
    """
    spark = vectors.sparkSession
    path, plain = scratch_path(spark, "codes"), scratch_path(spark, "vectors")
    usable(vectors).write.parquet(plain)
    sound = spark.read.parquet(plain)
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    count, asked, norm = sound.agg(F.count("*"), F.count_if(is_query), F.sqrt(F.max(squares))).first()
    if not count or not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = sound.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toArrow()
    flat = sample["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    dimension = len(flat) // sample.num_rows
    coder = learn(flat.reshape(-1, dimension), norm * (1 + 1e-12), k, recall)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(coder.rows(rows).view(np.int64))], ["vec_id", "vector", "code"]
            )

    sound.mapInArrow(encode, "vec_id long, vector array<double>, code long").write.parquet(path)
    coded = spark.read.parquet(path)
    wanted = min(k, count - 1)
    row_blocks = -(-count // block_rows)

    def search(queries: DataFrame, number: int, radius: int) -> DataFrame:
        query_blocks = max(1, -(-number // query_rows))
        spread = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
        rows = coded.select(
            F.pmod(F.xxhash64("vec_id"), F.lit(row_blocks)).alias("block"), spread.alias("part"), F.lit(0).alias("side"), "vec_id", "vector", "code"
        )
        spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long")))
        questions = queries.select(
            spread.alias("block"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_blocks)).cast("int").alias("part"),
            F.lit(1).alias("side"), "vec_id", "vector", "code",
        )
        found = rows.unionByName(questions).groupBy("block", "part").applyInArrow(
            _search(coder, k, substrings, radius, dimension), _FOUND
        )
        best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    queries = coded.where(is_query)
    first_path = scratch_path(spark, "nearest")
    search(queries, asked, coder.radius).write.parquet(first_path)
    first = spark.read.parquet(first_path)
    enough = first.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= wanted).select(F.col("query_id").alias("vec_id"))
    short = queries.join(enough, "vec_id", "left_anti")
    missing = short.count()
    columns = ["query_id", "rank", "vec_id", "score"]
    if not missing:
        return first.select(*columns)
    again = search(short, missing, coder.bits)
    done = first.join(enough.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi")
    return done.select(*columns).unionByName(again.select(*columns))


def op5_multi_index_hashing(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
