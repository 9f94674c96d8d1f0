"""Connected components by alternating star contractions: every step is an aggregation and a join, no vertex gathers its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)`` but the smallest of each component, which is its name.

    Links may repeat, run either way or join a node to itself; null ends are ignored. Steps repeat until nothing changes, a number
    that grows with the logarithm of the longest path.
    """
    edges = cut_lineage(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    seen = _signature(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u")
        edges = cut_lineage(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(root.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
    return int(row[0]), int(row[1])
