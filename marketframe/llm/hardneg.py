"""Hard negatives by inner product with cover trees: rows of another label whose score lies in a window below a positive's score.

Vectors become whole numbers, so every score is exact. Each is lengthened by one component that gives all of one length the same norm M; then
distances between rows bound angles, and angles bound inner products with a query: for a node with centre c whose rows lie within r of
it, ``<q, x>`` lies between ``|q| M cos(t + p)`` and ``|q| M cos(t - p)``, with t the angle between q and c and p the angle of the chord r.

A bounded sample gives pivots (farthest first); each row belongs to the nearest pivot's cell, and a cell is dealt into blocks by hash, so none is
large. A block's rows are stored with their cover tree: centres chosen farthest first, a level being those that are further apart than
the level's radius, which halves from level to level; each centre is in all finer levels too and keeps its covering radius in each.
A query goes to the cells whose bounds meet its window and may beat what the sample already holds. In a block nodes are visited by
descending upper bound; nodes outside the window are skipped, and the search ends when the next bound is below the worst of enough rows. Rows below the last level are
scored exactly. Blocks stream their queries, so a task holds one block, however many queries there are.

Of equal vectors with one label only the smallest ids can be among the first of any ranking; only those are indexed, so a vector that a third of all rows share
makes a few rows.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketframe.session import scratch_path

SAMPLE = 4096
PIVOTS = 256
BLOCK_ROWS = 2048
LEAF_ROWS = 128
_SLACK = 1e-7
_EXACT_FLOAT, _EXACT_LONG = 2.0**52, 2.0**62


# --- geometry -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Space:
    """Rows of one length: the common norm after lengthening, and the number type in which scores are exact."""

    norm: float
    kind: type

    def lift(self, rows: np.ndarray) -> np.ndarray:
        plain = rows.astype(np.float64)
        rest = np.sqrt(np.maximum(0.0, self.norm**2 - (plain * plain).sum(1)))
        return np.concatenate([plain, rest[:, None]], 1)

    def apart(self, lifted: np.ndarray, centre: np.ndarray) -> np.ndarray:
        """Distances to one centre, never too small."""
        gap = lifted - centre
        return np.sqrt((gap * gap).sum(1)) + _SLACK * self.norm

    def bounds(self, scores: np.ndarray, lengths: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest inner product of each query (a row of ``scores``) with rows within ``radii`` of the centres (its columns)."""
        full = (lengths * self.norm)[:, None]
        turn = np.arccos(np.clip(scores / np.where(full > 0, full, 1.0), -1.0, 1.0))
        wide = 2 * np.arcsin(np.minimum(1.0, radii / (2 * self.norm)))
        slack = _SLACK * full
        return full * np.cos(np.minimum(np.pi, turn + wide)) - slack, full * np.cos(np.maximum(0.0, turn - wide)) + slack


def spread_out(lifted: np.ndarray, space: Space, most: int) -> tuple[list[int], list[float], np.ndarray, np.ndarray]:
    """Farthest-first centres: the rows chosen, how far each was from the earlier ones, and every row's nearest centre and distance to it."""
    chosen, gaps = [0], [float("inf")]
    near = np.zeros(len(lifted), np.int64)
    apart = space.apart(lifted, lifted[0])
    while len(chosen) < most:
        far = int(apart.argmax())
        if apart[far] <= 2 * _SLACK * space.norm:
            break  # every row is a centre or equal to one
        gaps.append(float(apart[far]))
        other = space.apart(lifted, lifted[far])
        closer = other < apart
        near[closer], apart[closer] = len(chosen), other[closer]
        chosen.append(far)
    return chosen, gaps, near, apart


#: Rows below a centre, best first: negated scores and ids.
Ranked = tuple[list[float], list[int]]


@dataclass(frozen=True)
class Window:
    """What a query wants: scores from ``low`` to ``high``, and the score that enough rows are known to reach."""

    low: float
    high: float
    reach: int | None = None


class CoverTree:
    """Levels over one block of rows. Node ``(l, j)`` is centre ``j`` in level ``l``; below the last level rows stand in the order of their centres.

    ``order`` gives the place of each row in the block.
    """

    def __init__(self, space: Space, rows: np.ndarray, level: np.ndarray, parent: np.ndarray, radii: list[list[float]], centre: np.ndarray, leaf: np.ndarray):
        self.space, self.centres = space, rows[centre].astype(space.kind)
        self.order = np.argsort(leaf, kind="stable")
        self.rows = rows[self.order].astype(space.kind)
        self.starts = np.searchsorted(leaf[self.order], np.arange(len(level) + 1)).tolist()
        self.last = int(level.max())
        self.sizes = [int((level <= number).sum()) for number in range(self.last + 1)]
        self.radii = np.zeros((self.last + 1, len(level)))
        for j, own in enumerate(radii):
            self.radii[level[j] :, j] = own
        # The children of (l, j): itself and the centres that enter at l + 1 under it.
        self.children = [
            [[j, *entered[parent[entered] == j].tolist()] for j in range(self.sizes[number])]
            for number, entered in ((n, np.flatnonzero(level == n + 1)) for n in range(self.last))
        ]

    def bounds(self, queries: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level the lowest and highest inner product of each query with the rows of each node."""
        scores = (queries @ self.centres.T).astype(np.float64)
        lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
        return [self.space.bounds(scores[:, :n], lengths, self.radii[number, :n]) for number, n in enumerate(self.sizes)]

    @staticmethod
    def grow(space: Space, rows: np.ndarray, leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, ...]:
        """``(centre row, level, parent, radii)`` of the centres and the last-level centre of every row."""
        lifted = space.lift(rows)
        chosen, gaps, leaf, apart = spread_out(lifted, space, max(1, len(rows) // leaf_rows))
        top = gaps[1] if len(gaps) > 1 else 1.0
        # A centre enters at the first level whose radius its gap exceeds; later centres have smaller gaps, so levels are prefixes.
        level = np.array([0] + [1 + max(0, int(np.floor(np.log2(top / g)))) for g in gaps[1:]])
        level = np.unique(level, return_inverse=True)[1]
        parent, at = np.zeros(len(chosen), np.int64), lifted[chosen]
        for number in range(1, int(level.max()) + 1):
            entered, earlier = np.flatnonzero(level == number), int((level < number).sum())
            for j in entered:
                parent[j] = int(space.apart(at[:earlier], at[j]).argmin())
        radii: list[list[float]] = [[] for _ in chosen]
        under = leaf.copy()  # the node of the level that holds each row
        for number in range(int(level.max()), -1, -1):
            if number < level.max():
                under = np.where(level[under] > number, parent[under], under)
            for j in range(int((level <= number).sum())):
                held = np.flatnonzero(under == j)
                radii[j].insert(0, float(space.apart(lifted[held], at[j]).max()) if len(held) else 0.0)
        return np.array(chosen), level, parent, radii, leaf

    def best(self, low: list[list[float]], high: list[list[float]], window: Window, count: int, below: Callable[[int], Ranked]) -> list[tuple[int, int]]:
        """The first ``count`` ``(score, id)`` in the window, best first, given one query's bounds per level and the ranked rows below a centre."""
        bar, found = window.low if window.reach is None else max(window.low, window.reach), []
        heap = [(-high[0][0], 0, 0)]
        while heap:
            top, number, j = heapq.heappop(heap)
            if -top < bar:
                break
            if number == self.last:
                scores, ids = below(j)
                first = bisect.bisect_left(scores, -window.high)
                end = min(first + count, bisect.bisect_right(scores, -bar))
                if first < end:
                    found = heapq.nsmallest(count, [*found, *zip(scores[first:end], ids[first:end])])
                    if len(found) == count:
                        bar = max(bar, -found[-1][0])
                continue
            for k in self.children[number][j]:
                if high[number + 1][k] >= bar and low[number + 1][k] <= window.high:
                    heapq.heappush(heap, (-high[number + 1][k], number + 1, k))
        return [(int(-s), int(i)) for s, i in found]


# --- rows and the stored index ------------------------------------------------------------------


def whole_numbers(vectors: DataFrame, label: Column, scale: int = 256) -> DataFrame:
    """``(vec_id, label, vector)``: components times ``scale``, rounded down.

    Rows with a null id, label or vector or with a null or non-finite component are left out; rows that repeat an id count once, with the
    smallest label and vector. Zero vectors stay.
    """
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), v.alias("vector")).where(
        "vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL"
    ).where(~bad)
    floors = F.transform("vector", lambda x: F.floor(x * scale).cast("bigint"))
    one = sound.select("vec_id", F.struct("label", floors.alias("vector")).alias("row")).groupBy("vec_id").agg(F.min("row").alias("row"))
    return one.select("vec_id", "row.label", "row.vector")


def _matrix(column: pa.ChunkedArray | pa.Array, length: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def _by_length(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each vector length."""
    sizes = batch.column("vector").value_lengths() if isinstance(batch, pa.RecordBatch) else pa.compute.list_value_length(batch["vector"])
    sizes = np.asarray(sizes)
    for length in np.unique(sizes):
        yield int(length), np.flatnonzero(sizes == length)


@dataclass(frozen=True)
class Cells:
    """The cells of one vector length: pivots and, once rows are assigned, covering radii and blocks; and the sample."""

    space: Space
    pivots: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    sample: np.ndarray
    radii: np.ndarray | None = None
    blocks: tuple[tuple[int, ...], ...] = ()

    def reached(self, scores: np.ndarray, low: float, high: float, count: int) -> int | None:
        """The score that ``count`` of these sampled rows reach within the window; none with fewer."""
        scores = scores[(scores >= low) & (scores <= high)]
        return int(np.partition(scores, len(scores) - count)[len(scores) - count]) if len(scores) >= count else None


_INDEX = "block long, vec_id long, label long, vector array<long>, centre int, level int, parent int, radii array<double>, leaf int"


@dataclass(frozen=True)
class Index:
    """Stored blocks, and the cells that lead to them."""

    rows: DataFrame
    cells: dict[int, Cells]


def build_index(rows: DataFrame, copies: int, block_rows: int = BLOCK_ROWS, sample_rows: int = SAMPLE) -> Index:
    """Index ``(vec_id, label, vector)``; of equal vectors with one label the ``copies`` smallest ids suffice for the queries to come."""
    spark = rows.sparkSession
    same = W.partitionBy("label", F.xxhash64("vector"), "vector").orderBy("vec_id")
    distinct = scratch_path(spark, "distinct")
    rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= copies).drop("copy").write.parquet(distinct)
    kept = spark.read.parquet(distinct)
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    lengths = kept.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"), F.max(squares).alias("square")).collect()
    if any(r.square >= _EXACT_LONG for r in lengths):
        raise ArithmeticError("scores of these vectors do not fit 64 bits")
    taken = kept.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toArrow()
    sampled = {length: taken.take(at) for length, at in _by_length(taken)} if taken.num_rows else {}
    cells = {}
    for r in lengths:
        space = Space(max(1.0, float(np.sqrt(r.square)) * (1 + 1e-12)), np.float64 if r.square < _EXACT_FLOAT else np.int64)
        part, wanted = sampled.get(r.length), min(PIVOTS, -(-r.n // block_rows))
        if part is None:  # a length too rare for the sample has one cell around the origin
            ids, labels, table, pivots = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, r.length), space.kind), np.zeros((1, r.length), np.int64)
        else:
            table = _matrix(part["vector"], r.length)
            pivots = table[spread_out(space.lift(table), space, wanted)[0]]
            ids, labels, table = part["vec_id"].to_numpy(), part["label"].to_numpy(), table.astype(space.kind)
        cells[r.length] = Cells(space, pivots, ids, labels, table)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lifted = {length: c.space.lift(c.pivots) for length, c in cells.items()}
        for batch in batches:
            cell, apart = np.zeros(len(batch), np.int32), np.zeros(len(batch))
            for length, at in _by_length(batch):
                space, vectors = cells[length].space, cells[length].space.lift(_matrix(batch.column("vector").take(at), length))
                gaps = np.stack([space.apart(vectors, p) for p in lifted[length]])
                cell[at], apart[at] = gaps.argmin(0), gaps.min(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(apart)], ["vec_id", "label", "vector", "cell", "apart"])

    assigned = scratch_path(spark, "cells")
    kept.mapInArrow(assign, "vec_id long, label long, vector array<long>, cell int, apart double").write.parquet(assigned)
    placed = spark.read.parquet(assigned)
    # One row per cell: at most PIVOTS for each vector length.
    found = placed.groupBy(F.size("vector").alias("length"), "cell").agg(F.count("*").alias("n"), F.max("apart").alias("radius")).collect()
    first, blocks, starts = 0, {}, []
    for r in sorted(found):
        number = -(-r.n // block_rows)
        blocks[r.length, r.cell] = (tuple(range(first, first + number)), r.radius)
        starts.append((r.length, r.cell, first, number))
        first += number
    full = {}
    for length, c in cells.items():
        own = [blocks.get((length, i), ((), 0.0)) for i in range(len(c.pivots))]
        full[length] = Cells(c.space, c.pivots, c.ids, c.labels, c.sample, np.array([o[1] for o in own]), tuple(o[0] for o in own))
    where = spark.createDataFrame(starts or [], "length int, cell int, start long, number long")
    dealt = placed.join(F.broadcast(where), (F.size("vector") == F.col("length")) & (placed.cell == where.cell)).select(
        (F.col("start") + F.pmod(F.xxhash64("vec_id"), "number")).alias("block"), "vec_id", "label", "vector"
    )

    def grow(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        length = len(table["vector"][0])
        chosen, level, parent, radii, leaf = CoverTree.grow(full[length].space, _matrix(table["vector"], length))
        own = {int(row): j for j, row in enumerate(chosen)}
        centre = [own.get(i) for i in range(len(table))]
        pick = lambda values: [None if j is None else values[j] for j in centre]
        for name, values, kind in (
            ("centre", centre, pa.int32()), ("level", pick(level.tolist()), pa.int32()), ("parent", pick(parent.tolist()), pa.int32()),
            ("radii", pick(radii), pa.list_(pa.float64())), ("leaf", leaf.tolist(), pa.int32()),
        ):
            table = table.append_column(name, pa.array(values, kind))
        return table

    path = scratch_path(spark, "cover-trees")
    dealt.groupBy("block").applyInArrow(grow, _INDEX).write.parquet(path)
    return Index(spark.read.parquet(path), full)


# --- queries ------------------------------------------------------------------------------------

#: What one query asks of a row set: windows to fill, given its positives' scores, and which labels may fill them.
Windows = Callable[[list[int]], list[tuple[int, float, float]]]


def _routed(queries: DataFrame, index: Index, count: int, same_label: bool, windows: Windows) -> DataFrame:
    """Each query once per block that may hold one of its best rows; ``reach`` is the score the sample already gives for each window."""
    cells = index.cells

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sent, to, reaches = [], [], []
            ids, labels, given = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), batch.column("given").to_pylist()
            for length, at in _by_length(batch):
                own = cells[length]
                vectors = _matrix(batch.column("vector").take(at), length).astype(own.space.kind)
                scores = (vectors @ own.pivots.astype(own.space.kind).T).astype(np.float64)
                lows, highs = own.space.bounds(scores, np.sqrt((vectors.astype(np.float64) ** 2).sum(1)), own.radii)
                for i, query, low, high in zip(at, vectors, lows, highs):
                    same = own.labels == labels[i]
                    sampled = own.sample[same & (own.ids != ids[i]) if same_label else ~same] @ query
                    meets, reach = np.zeros(len(low), bool), []
                    for _, least, most in windows(given[i]):
                        known = own.reached(sampled, least, most, count)
                        meets |= (high >= (least if known is None else known)) & (low <= most)
                        reach.append(known)
                    targets = [b for c in np.flatnonzero(meets) for b in own.blocks[c]]
                    sent += [i] * len(targets)
                    to += targets
                    reaches += [reach] * len(targets)
            part = batch.take(pa.array(sent, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int64()), *part.columns, pa.array(reaches, pa.list_(pa.int64()))],
                ["block", "vec_id", "label", "vector", "given", "reach"],
            )

    return queries.select("vec_id", "label", "vector", "given").mapInArrow(
        route, "block long, vec_id long, label long, vector array<long>, given array<long>, reach array<long>"
    )


class _Block:
    """One block's rows as they arrive, and its tree once the first query does."""

    def __init__(self) -> None:
        self.parts: list[pa.RecordBatch] = []
        self.tree: CoverTree | None = None

    def ready(self, cells: dict[int, Cells]) -> None:
        table = pa.Table.from_batches(self.parts)
        length = len(table["vector"][0])
        ids, labels = table["vec_id"].to_numpy(), table["label"].to_numpy()
        centre = np.asarray(table["centre"].fill_null(-1))
        row = np.argsort(np.where(centre < 0, len(centre), centre), kind="stable")[: int((centre >= 0).sum())]
        nodes = table.take(row)
        self.tree = CoverTree(
            cells[length].space, _matrix(table["vector"], length), nodes["level"].to_numpy(), nodes["parent"].to_numpy(),
            nodes["radii"].to_pylist(), row, table["leaf"].to_numpy(),
        )
        self.ids, self.labels = ids[self.tree.order], labels[self.tree.order]
        self.parts = []

    def ranked(self, query: np.ndarray, allowed: np.ndarray) -> Callable[[int], Ranked]:
        """The allowed rows below a centre by their exact scores, worked out once per query."""
        tree, seen = self.tree, {}

        def below(j: int) -> Ranked:
            if j not in seen:
                low, high = tree.starts[j], tree.starts[j + 1]
                fits = allowed[low:high]
                scores, ids = -(tree.rows[low:high] @ query)[fits], self.ids[low:high][fits]
                order = np.lexsort((ids, scores))
                seen[j] = scores[order].tolist(), ids[order].tolist()
            return seen[j]

        return below


def _search(queries: DataFrame, index: Index, count: int, same_label: bool, windows: Windows) -> DataFrame:
    """``(query_id, window, vec_id, score)``: the best rows of every block for every window of every query."""
    cells = index.cells
    asked = _routed(queries, index, count, same_label, windows)
    extra = ("centre", "level", "parent", "radii", "leaf")
    rows = index.rows.withColumns({"side": F.lit(0), "given": F.lit(None).cast("array<long>"), "reach": F.lit(None).cast("array<long>")})
    both = rows.unionByName(asked.withColumn("side", F.lit(1)), allowMissingColumns=True)
    # Within a partition a block's rows come first and its queries after them: the queries are streamed, however many there are.
    met = both.repartition("block").sortWithinPartitions("block", "side").select(
        "block", "side", "vec_id", "label", "vector", *extra, "given", "reach"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block = None, _Block()
        for batch in batches:
            out = ([], [], [], [])
            numbers, sides = batch.column("block").to_numpy(), batch.column("side").to_numpy()
            edges = np.flatnonzero((numbers[1:] != numbers[:-1]) | (sides[1:] != sides[:-1])) + 1
            for low, high in zip([0, *edges], [*edges, len(numbers)]):
                if high == low:
                    continue
                if numbers[low] != current:
                    current, block = numbers[low], _Block()
                part = batch.slice(low, high - low)
                if not sides[low]:
                    block.parts.append(part)
                    continue
                if block.tree is None:
                    block.ready(cells)
                tree = block.tree
                vectors = _matrix(part.column("vector"), tree.rows.shape[1]).astype(tree.rows.dtype)
                bounds = tree.bounds(vectors)
                for i, (query_id, label, given, reach) in enumerate(zip(*(part.column(c).to_pylist() for c in ("vec_id", "label", "given", "reach")))):
                    allowed = block.labels == label
                    allowed = allowed & (block.ids != query_id) if same_label else ~allowed
                    low, high = ([side[i].tolist() for side in sides_] for sides_ in zip(*bounds))
                    below = block.ranked(vectors[i], allowed)
                    for (window, least, most), known in zip(windows(given), reach):
                        for score, vec_id in tree.best(low, high, Window(least, most, known), count, below):
                            for column, value in zip(out, (query_id, window, vec_id, score)):
                                column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["query_id", "window", "vec_id", "score"])

    found = met.mapInArrow(run, "query_id long, window long, vec_id long, score long")
    best = W.partitionBy("query_id", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for the anchors among ``(vec_id, label, vector)``.

    An anchor's positives are the first ``positives`` other rows of its label. The negatives of a positive are the first ``negatives`` rows of another label
    whose score is from ``least`` to ``most`` percent of the positive's; a pair with none gives no row, nor does an empty window (a
    negative positive score). Ties go to the smaller id. Rows of different length never meet. All results are exact.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "whole-numbers")
    rows.write.parquet(path)
    stored = spark.read.parquet(path)
    index = build_index(stored, max(positives + 1, negatives), block_rows)
    anchors = stored.where(is_anchor)
    first = scratch_path(spark, "positives")
    everything = float("inf")
    _search(
        anchors.withColumn("given", F.array().cast("array<long>")), index, positives, True, lambda given: [(0, -everything, everything)]
    ).write.parquet(first)
    found = spark.read.parquet(first)

    def below(given: list[int]) -> list[tuple[int, float, float]]:
        limits = [(p, -(-least * p // 100), most * p // 100) for p in given]
        return [(p, low, high) for p, low, high in limits if low <= high]

    wanted = found.groupBy("query_id").agg(F.collect_set("score").alias("given"))  # at most as many as there are positives
    queries = anchors.join(wanted, F.col("vec_id") == F.col("query_id"))
    hard = _search(queries, index, negatives, False, below)
    return found.select(F.col("query_id").alias("anchor_id"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).join(
        hard.select(
            F.col("query_id").alias("anchor_id"), F.col("window").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"),
            F.col("score").alias("negative_score"),
        ),
        ["anchor_id", "positive_score"],
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_cover_tree_negatives(spark, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(whole_numbers(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label), F.col("vec_id") % 50 == 0)


def negatives_sql() -> str:
    """The same in DuckDB's SQL."""
    return """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
