"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Each source is laid out in shards (documents dealt by a hash, so a source of any size has shards of about equal length), a shard in
blocks of ``block`` words. The blocks of the whole mix go to the sources by highest quotients of their targets, those of a source to its
shards by highest quotients of their words: whole numbers everywhere. A shard of n blocks and quota q takes all of its blocks
q div n times, and q mod n of them once more: those a seeded permutation of the block numbers puts first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketframe.llm.words import WORD
from marketframe.operators.ordered import ordinal_rank
from marketframe.session import cut_lineage, scratch_path

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 16
SHARD_WORDS = 200_000
SEED = 17
# Primes above any number of blocks in a shard, so multiplying by one permutes the block numbers.
_PRIMES = [2147483647, 2147483629, 2147483587, 2147483579]


def sainte_lague(votes: DataFrame, key: str, group: str) -> DataFrame:
    """``votes (group, key, votes, total)`` with ``seats``: ``total`` seats of each group by highest quotients votes / (2 seats + 1).

    Equal quotients go to the smaller key. Seats that any divisor near the right one gives are counted at once; only the few in
    between, at most about three per key, are ranked. Keys without votes get none. The votes are materialised, one row per key.
    """
    votes = cut_lineage(votes)
    sums = votes.groupBy(group).agg(F.sum("votes").alias("__all"), F.count_if(F.col("votes") > 0).alias("__n"))
    spare = F.col("__n") / 2 + 1
    above = F.col("total") - spare
    bounded = votes.join(sums, group).withColumns({
        "__sure": F.when((above > 0) & (F.col("votes") > 0), F.floor(F.col("votes") * above / F.col("__all") + 0.5)).otherwise(0),
        "__most": F.when(F.col("votes") > 0, F.floor(F.col("votes") * (F.col("total") + spare) / F.col("__all") + 0.5)).otherwise(0),
    })
    contested = bounded.where("__most > __sure").select(
        group, key, "votes", F.explode(F.sequence(F.col("__sure") + 1, F.col("__most"))).alias("__seat")
    ).withColumn("__falling", -F.col("votes") / (2 * F.col("__seat") - 1))
    ranked = ordinal_rank(contested, ["__falling", key, "__seat"], "__rank", by=[group])
    left = bounded.groupBy(group).agg((F.first("total") - F.sum("__sure")).alias("__left"))
    won = ranked.join(left, group).where("__rank <= __left").groupBy(group, key).agg(F.count("*").alias("__won"))
    seats = F.col("__sure") + F.coalesce("__won", F.lit(0))
    return bounded.join(won, [group, key], "left").withColumn("seats", seats.cast("long")).drop(
        "__all", "__n", "__sure", "__most", "__won"
    )


def source_targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``(source, source_size, pos, target)`` from ``(source, source_size)``: targets by weight, none above ``most`` times its size.

    The common factor rises until no more sources stop at their limit; each step takes two sums over the sources.
    """
    numbered = ordinal_rank(sources.withColumn("__null", F.col("source").isNull()), ["__null", "source"], "pos")
    placed = cut_lineage(numbered.drop("__null"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("pos") - 1) % len(weights)).cast("int"))
    limit = F.col("source_size") * float(most)
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    factor, goal = 0.0, share * total
    while True:
        stopped = limit < weight * factor
        full, open_weight = placed.agg(
            F.coalesce(F.sum(F.when(stopped, limit)), F.lit(0.0)), F.coalesce(F.sum(F.when(~stopped, weight)), F.lit(0.0))
        ).first()
        if not open_weight:
            break
        new = (goal - full) / open_weight
        if new <= factor:
            break
        factor = new
    return placed.withColumn("target", F.least(limit, weight * factor))


def _chosen(block: Column) -> Column:
    """Whether the seeded permutation puts a block number among the first ``rest``."""
    return (block * F.col("factor") + F.col("offset")) % F.col("n_blocks") < F.col("rest")


def plan(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
    block: int = BLOCK, shard_words: int = SHARD_WORDS, seed: int = SEED,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, doc_key, size, source_size, target, taken`` and where its words lie.

    ``begin`` is the place of its first word in its shard; ``passes, n_blocks, factor, offset, rest`` say which blocks of the shard are
    taken. A null text has size 0; null sources form a source of their own, placed last; repeated rows and null ids count like any other
    row. Reruns on equal rows agree, in whatever order they come. An empty table gives an empty plan.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "sizes")
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size")
    docs.select("doc_id", "source", F.xxhash64("text").alias("doc_key"), size).write.parquet(path)
    sizes = spark.read.parquet(path)
    targets_path = scratch_path(spark, "targets")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    source_targets(sources, weights, share, most).write.parquet(targets_path)
    targets = spark.read.parquet(targets_path)
    blocks = round((targets.agg(F.sum("target")).first()[0] or 0) / block)
    quotas = sainte_lague(
        targets.select("pos", (F.col("pos") % 1).alias("mix"), F.col("target").alias("votes"), F.lit(blocks).cast("long").alias("total")),
        "pos", "mix",
    ).select("pos", F.col("seats").alias("total"))

    shards_of = F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))
    known = sizes.join(
        targets.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))
    ).drop("__source", "source")
    dealt = known.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "doc_key"), shards_of))
    shards = dealt.groupBy("pos", "shard").agg(F.sum("size").cast("double").alias("votes"))
    seats = sainte_lague(shards.join(quotas, "pos"), "shard", "pos")
    n_blocks = F.greatest(F.ceil(F.col("votes") / block), F.lit(1)).cast("long")
    draw = F.xxhash64(F.lit(seed), "pos", "shard")
    chosen = seats.withColumn("n_blocks", n_blocks).select(
        "pos", "shard", "n_blocks",
        F.least("seats", F.col("n_blocks") * most).alias("quota"),
        F.get(F.array(*[F.lit(p) for p in _PRIMES]), F.pmod(draw, F.lit(len(_PRIMES))).cast("int")).alias("factor"),
        F.pmod(F.shiftright(draw, 8), F.col("n_blocks")).alias("offset"),
    )
    # Shards are of bounded length, whatever the source, so this window has no hot partition.
    earlier = W.partitionBy("pos", "shard").orderBy("doc_id", "doc_key").rowsBetween(W.unboundedPreceding, -1)
    laid = dealt.withColumn("begin", F.coalesce(F.sum("size").over(earlier), F.lit(0).cast("long")))
    placed = laid.join(chosen, ["pos", "shard"]).withColumns({
        "passes": F.expr("quota div n_blocks"), "rest": F.expr("quota % n_blocks")
    })
    end = F.col("begin") + F.col("size")
    numbers = F.sequence(F.expr(f"begin div {block}"), F.expr(f"(begin + size - 1) div {block}"))
    part = F.aggregate(
        F.when(F.col("size") > 0, F.filter(numbers, _chosen)).otherwise(F.array().cast("array<bigint>")),
        F.lit(0).cast("long"),
        lambda total, k: total + F.least((k + 1) * block, end) - F.greatest(k * block, F.col("begin")),
    )
    return placed.select(
        "doc_id", "doc_key", "size", "source_size", "target", (F.col("passes") * F.col("size") + part).alias("taken"),
        "begin", "passes", "n_blocks", "factor", "offset", "rest",
    )


def mix(docs: DataFrame, keep: list[str], block: int = BLOCK, **options) -> DataFrame:
    """``keep`` of the rows of which the mix takes any word; ``text`` in ``keep`` is what it takes.

    That is the whole text once per full pass, then its words in the blocks taken once more, joined by single spaces; parts are
    joined by a line end. Rows that are equal in id and text give equal results in their number.
    """
    planned = plan(docs, block=block, **options).where("taken > 0")
    order = W.partitionBy("doc_id", "doc_key").orderBy("begin", "n_blocks", "offset")
    numbered = planned.withColumn("__copy", F.row_number().over(order))
    here = W.partitionBy("__doc", "__key").orderBy(F.lit(0))
    row = F.struct(*[F.col(k) for k in keep if k != "text"]).alias("__row") if keep != ["text"] else F.lit(0).alias("__row")
    rows = docs.select(row, F.col("doc_id").alias("__doc"), F.col("text").alias("__text"), F.xxhash64("text").alias("__key"))
    rows = rows.withColumn("__copy_here", F.row_number().over(here))
    words = F.regexp_extract_all("__text", F.lit(f"({WORD})"), 1)
    extra = F.array_join(F.filter(words, lambda _, i: _chosen(F.floor((F.col("begin") + i) / block))), " ")
    parts = F.concat(
        F.array_repeat(F.col("__text"), F.col("passes").cast("int")), F.when(extra != "", F.array(extra)).otherwise(F.array().cast("array<string>"))
    )
    joined = rows.join(
        numbered.select(F.col("doc_id").alias("__id"), "doc_key", "__copy", "begin", "passes", "n_blocks", "factor", "offset", "rest"),
        F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("doc_key")) & (F.col("__copy_here") == F.col("__copy")),
    )
    return joined.select(*[F.array_join(parts, "\n").alias("text") if k == "text" else F.col(f"__row.{k}") for k in keep])


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return plan(docs).select("doc_id", "size", "source_size", "target", "taken")
