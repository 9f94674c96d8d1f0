"""Ordered work per key that stays balanced when one key holds most of the rows.

A window over ``partitionBy(key)`` sends the whole key to one task. That is fine for a monthly
panel, where a key has one row per month. For raw rows the helpers below cut each hot key into
consecutive segments along its order and repair the segment edges exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketframe.session import broadcast_if_small, cut_lineage

_SEGMENT, _EDGE = "__segment", "__edge"
_OVERSAMPLE = 20

Expressions = Mapping[str, Callable[[WindowSpec], Column]]


@dataclass(frozen=True)
class Segments:
    """Cut points along ``order`` for the hot keys only: at most one row per shuffle partition.

    ``longest`` is the number of cuts of the key that has most.
    """

    by: tuple[str, ...]
    order: tuple[str, ...]
    bounds: DataFrame
    longest: int

    def tag(self, df: DataFrame) -> DataFrame:
        """Add the segment number, found by bisection; rows of ordinary keys are all in segment 0."""
        steps = [2**i for i in reversed(range(self.longest.bit_length()))]
        key = F.struct(*self.order)

        def advance(below: Column, step: Column) -> Column:
            passed = F.try_element_at("__bounds", below + step) < key
            return F.when(passed, below + step).otherwise(below)

        place = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)
        return (
            df.join(broadcast_if_small(self.bounds, 256), list(self.by), "left")
            .withColumn(_SEGMENT, place)
            .withColumn("__hot", F.col("__bounds").isNotNull())
            .drop("__bounds")
        )


def find_segments(
    df: DataFrame, by: Sequence[str], order: Sequence[str], share: float = 0.5
) -> Segments | None:
    """Cut points for keys that outgrow a fair share of the rows, or None when there are none.

    A key is hot above an even split of the table over the shuffle partitions, so there are fewer hot keys
    than partitions. Each is cut into pieces of about ``share`` of such an even split: with more partitions there are
    more and smaller pieces, whatever the size of the key. The cut points are quantiles of the whole order, taken from
    the hash-selected ordering values of a few rows; they only decide where a key is cut, every row stays.
    They are materialised once, so all later uses agree. ``order`` columns sort ascending, and together
    should be nearly unique: rows equal in all of them stay in one segment.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Counted once: nothing else is read when no key is hot.
    counts = cut_lineage(df.groupBy(*by).agg(F.count("*").alias("__n")))
    even = (counts.agg(F.sum("__n")).first()[0] or 0) / parts
    hot = counts.where(F.col("__n") > even).withColumn(
        "__pieces", F.greatest(F.ceil(F.col("__n") / (even * share)), F.lit(2)).cast("int")
    )
    if not even or hot.isEmpty():
        return None
    # About _OVERSAMPLE rows per piece of each hot key, whatever its size.
    grain = F.greatest((F.col("__n") / (F.col("__pieces") * _OVERSAMPLE)).cast("bigint"), F.lit(1))
    # Fewer hot keys than partitions by the condition above, so broadcasting them is safe at any size.
    picked = df.select(*by, *order).join(F.broadcast(hot), list(by)).where(F.pmod(F.xxhash64(*order), grain) == 0)
    values = F.array_sort(F.collect_list(F.struct(*order)))
    found = picked.groupBy(*by, "__pieces").agg(values.alias("__values"))
    at = F.transform(
        F.sequence(F.lit(1), F.col("__pieces") - 1),
        lambda i: F.element_at("__values", F.greatest((F.size("__values") * i / F.col("__pieces")).cast("int"), F.lit(1))),
    )
    bounds = cut_lineage(found.select(*by, F.array_distinct(at).alias("__bounds")))
    longest = bounds.agg(F.max(F.size("__bounds"))).first()[0]
    return Segments(tuple(by), tuple(order), bounds, longest) if longest else None


def over_recent_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    lookback: int,
    expressions: Expressions,
    segments: Segments | None = None,
) -> DataFrame:
    """Add window columns that need at most ``lookback`` earlier rows of the same key.

    ``expressions`` maps a name to a function of the ordered window. With ``segments`` every segment
    is given a copy of the ``lookback`` rows before it; the copies are dropped afterwards.
    """
    if not expressions:
        return df
    if segments is None:
        spec = W.partitionBy(*by).orderBy(*order)
        return df.withColumns({name: make(spec) for name, make in expressions.items()})

    tagged = segments.tag(df)
    spec = W.partitionBy(*by, _SEGMENT).orderBy(*order)
    edges = _edge_rows(tagged, by, order, lookback, df.columns)
    both = tagged.drop("__hot").withColumn(_EDGE, F.lit(False)).unionByName(edges)
    return (
        both.withColumns({name: make(spec) for name, make in expressions.items()})
        .where(~F.col(_EDGE))
        .drop(_SEGMENT, _EDGE)
    )


def _edge_rows(
    tagged: DataFrame, by: Sequence[str], order: Sequence[str | Column], lookback: int, columns: Sequence[str]
) -> DataFrame:
    """For every segment of a hot key, the ``lookback`` rows that come before it.

    Each segment contributes its own last rows (limited before the shuffle), so a key has at most
    pieces x lookback of them. Every segment present has a row, hence ``lookback`` earlier segments
    always suffice.
    """
    backwards = W.partitionBy(*by, _SEGMENT).orderBy(*[_descending(o) for o in order])
    last = (
        tagged.where("__hot")
        .withColumn("__rn", F.row_number().over(backwards))
        .where(F.col("__rn") <= lookback)
        .groupBy(*by, _SEGMENT)
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("__rn")).alias("p"), F.struct(*columns).alias("row")))).alias("__own"))
    )
    earlier = W.partitionBy(*by).orderBy(_SEGMENT).rowsBetween(-lookback, -1)
    gathered = last.withColumn("__before", F.flatten(F.collect_list("__own").over(earlier)))
    start = F.greatest(F.size("__before") - lookback + 1, F.lit(1))
    return (
        gathered.select(_SEGMENT, F.explode(F.slice("__before", start, F.lit(lookback))).alias("e"))
        .select("e.row.*", _SEGMENT)
        .withColumn(_EDGE, F.lit(True))
    )


def _descending(order: str | Column) -> Column:
    """Order columns are plain ascending names; the reverse must also flip the place of NULLs."""
    return F.col(order).desc_nulls_last() if isinstance(order, str) else order.desc_nulls_last()


def by_segment(df: DataFrame, by: Sequence[str], segments: Segments | None) -> tuple[DataFrame, list[str]]:
    """Tagged rows and the finer key for two-level aggregation; without segments the rows and key as they are."""
    if segments is None:
        return df, list(by)
    return segments.tag(df).drop("__hot"), [*by, _SEGMENT]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. The rank filter is applied before the shuffle as well as after it."""
    spec = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(spec)).where(F.col("__rn") == 1).drop("__rn")


def ordinal_rank(
    df: DataFrame, order: Sequence[str | Column], name: str, by: Sequence[str] = (), total: str | None = None
) -> DataFrame:
    """1-based row number in a total order, whole table or per ``by``, without a single-task sort.

    Rows are range partitioned on the full order, numbered inside each partition, and shifted by the
    sizes of the partitions before. ``order`` must be unique per row; ties on a value are then split
    like any other rows. ``total`` names a column for the number of rows ranked together.
    """
    spec = [*by, *order]
    ranged = cut_lineage(
        df.repartitionByRange(*spec)
        .sortWithinPartitions(*spec)
        .withColumns({"__part": F.spark_partition_id(), "__mono": F.monotonically_increasing_id()})
    )
    keys = [f"__by{i}" for i in range(len(by))]
    pieces = ranged.groupBy("__part", *[F.col(c).alias(k) for c, k in zip(by, keys)]).agg(
        F.count("*").alias("__size"), F.min("__mono").alias("__first")
    )
    # A piece is one key within one partition: a key has at most as many as there are partitions, so no window below is long.
    whole = W.partitionBy(*keys)
    before = whole.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    counted = {total: F.sum("__size").over(whole)} if total else {}
    places = pieces.withColumns({"__before": F.coalesce(F.sum("__size").over(before), F.lit(0)), **counted})
    if not by:
        places = F.broadcast(places)  # one row per partition
    # Pieces meet their rows by key and partition, so the rows of a hot key stay spread.
    same = F.col("__part") == F.col("__at")
    for column, key in zip(by, keys):
        same = same & F.col(column).eqNullSafe(F.col(key))
    return (
        ranged.join(places.withColumnRenamed("__part", "__at"), same)
        .withColumn(name, F.col("__before") + F.col("__mono") - F.col("__first") + 1)
        .drop("__part", "__mono", "__at", "__size", "__first", "__before", *keys)
    )
