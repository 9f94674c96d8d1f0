"""The SQL query catalogue over the views ``stocks``, ``crypto`` and ``weather``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe import constants as C
from marketframe.functions import case_label, dollar_volume_billions, stable_round
from marketframe.operators.ordered import find_segments, first_per_key
from marketframe.operators.panel import rolling_mean
from marketframe.session import broadcast_if_small, cut_lineage


def default_groups() -> dict[str, list[str]]:
    """Symbols per category, without the category that catches the rest."""
    groups: dict[str, list[str]] = {}
    for symbol, category, _ in C.SECURITIES:
        if category != "Control":
            groups.setdefault(category, []).append(symbol)
    return groups


def newest_quotes(stocks: DataFrame, order_col: str, tiebreak: Sequence[str]) -> DataFrame:
    """One row per symbol and trading day, the newest extraction winning."""
    order = [F.col(order_col).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tiebreak]]
    return first_per_key(stocks, ["symbol", "trading_day"], order)


def daily_leader(spark: SparkSession, tiebreak: Sequence[str] = ("symbol",), **_) -> DataFrame:
    """Highest percent change of each trading day."""
    ties = ", ".join(tiebreak)
    return spark.sql(f"""
        SELECT symbol, trading_day, change_percent
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY trading_day ORDER BY change_percent DESC NULLS LAST, {ties}) AS place
              FROM stocks)
        WHERE place = 1
        ORDER BY trading_day DESC NULLS LAST""")


def asset_summary(spark: SparkSession, **_) -> DataFrame:
    """Distinct assets and average price per asset class."""

    def line(name: str, view: str, assets, value: str) -> DataFrame:
        return spark.table(view).agg(
            F.lit(name).alias("asset_class"), assets.alias("assets"), stable_round(F.avg(value), 2).alias("avg_price")
        )

    symbols = F.count_distinct("symbol")
    return (
        line("Stocks", "stocks", symbols, "price")
        .unionByName(line("Crypto", "crypto", symbols, "price"))
        .unionByName(line("Weather", "weather", F.lit(1).cast("bigint"), "temperature"))
    )


def change_spread(spark: SparkSession, **_) -> DataFrame:
    """Worst and best day per symbol with more than one row, widest spread first."""
    low, high = F.min("change_percent"), F.max("change_percent")
    return (
        spark.table("stocks")
        .groupBy("symbol")
        .agg(
            F.count("*").alias("data_points"),
            stable_round(low, 2).alias("worst_day"),
            stable_round(high, 2).alias("best_day"),
            stable_round(high - low, 2).alias("spread"),
        )
        .where(F.col("data_points") > 1)
        .orderBy(F.col("spread").desc_nulls_last(), "symbol")
    )


def moving_average(
    spark: SparkSession,
    tiebreak: Sequence[str] = ("timestamp",),
    keep: Sequence[str] = (),
    **_,
) -> DataFrame:
    """Mean price of the row and the two before it, per symbol in trading-day order.

    Symbols holding too many rows for one task are cut into segments.
    """
    order = ["trading_day", *tiebreak]
    rows = spark.table("stocks").select(*dict.fromkeys(["symbol", *order, "price", *keep]))
    segments = find_segments(rows, ["symbol"], order)
    averaged = rolling_mean(rows, "symbol", order, "price", 3, name="mean", segments=segments)
    tiebreak_only = [c for c in tiebreak if c not in ("symbol", "trading_day", "price", *keep)]
    listed = averaged.select(
        *keep, "symbol", "trading_day", "price", stable_round("mean", 2).alias("moving_avg_3d"), *tiebreak_only
    )
    # The tiebreak is part of the sort so that a symbol's busiest day can be split over several ranges.
    order = [F.col(c).asc_nulls_last() for c in ("symbol", "trading_day", *tiebreak)]
    return listed.orderBy(*order).drop(*tiebreak_only)


def high_volume(spark: SparkSession, keep: Sequence[str] = (), **_) -> DataFrame:
    """Rows trading more than 1.5 times their symbol's average volume.

    The averages are one row per symbol. They are stored and counted first: joined as a broadcast the
    large table is not shuffled at all, and beyond the limit the join is split by symbol size.
    """
    stocks = spark.table("stocks")
    averages = cut_lineage(stocks.groupBy("symbol").agg(F.avg("volume").alias("mean_volume")))
    ratio = F.col("volume").cast("double") / F.col("mean_volume")
    return (
        stocks.join(broadcast_if_small(averages), "symbol")
        .where(F.col("volume") > F.col("mean_volume") * 1.5)
        .select(
            *keep, "symbol", "trading_day", "price", "volume", "change_percent",
            stable_round("mean_volume", 0).alias("avg_volume"), stable_round(ratio, 2).alias("volume_ratio"),
            ratio.alias("exact"),
        )
        # Rounded ratios repeat very often; the exact one spreads the sort and keeps the rounded order.
        .orderBy(F.col("exact").desc_nulls_last())
        .drop("exact")
    )


def price_range(spark: SparkSession, **_) -> DataFrame:
    """Low, high and range per crypto symbol, widest relative range first."""
    low, high = F.min("price"), F.max("price")
    return (
        spark.table("crypto")
        .groupBy("symbol")
        .agg(
            low.alias("low"),
            high.alias("high"),
            stable_round(high - low, 2).alias("range"),
            stable_round(F.try_divide(high - low, low) * 100, 2).alias("range_pct"),
        )
        .orderBy(F.col("range_pct").desc_nulls_last(), "symbol")
    )


def category_performance(
    spark: SparkSession,
    order_col: str = "timestamp",
    tiebreak: Sequence[str] = (),
    groups: Mapping[str, Sequence[str]] | None = None,
    **_,
) -> DataFrame:
    """Average change and volume per category over de-duplicated quotes."""
    newest = newest_quotes(spark.table("stocks"), order_col, tiebreak)
    return (
        newest.groupBy(case_label("symbol", groups or default_groups(), "Control").alias("category"))
        .agg(
            stable_round(F.avg("change_percent"), 2).alias("avg_daily_change"),
            stable_round(F.avg("volume"), 0).alias("avg_volume"),
            F.count_distinct("symbol").alias("stocks"),
        )
        .orderBy(F.col("avg_daily_change").desc_nulls_last(), "category")
    )


def dollar_volume(
    spark: SparkSession, order_col: str = "timestamp", tiebreak: Sequence[str] = (), keep: Sequence[str] = (), **_
) -> DataFrame:
    """De-duplicated quotes by traded value."""
    newest = newest_quotes(spark.table("stocks"), order_col, tiebreak)
    return newest.orderBy((F.col("price") * F.col("volume")).desc_nulls_last()).select(
        *keep, "symbol", "price", "volume",
        dollar_volume_billions("price", "volume").alias("dollar_volume_B"), "change_percent",
    )


QUERIES: dict[str, Callable[..., DataFrame]] = {
    "daily_leader": daily_leader,
    "asset_summary": asset_summary,
    "change_spread": change_spread,
    "moving_average": moving_average,
    "high_volume": high_volume,
    "price_range": price_range,
    "category_performance": category_performance,
    "dollar_volume": dollar_volume,
}


def run(spark: SparkSession, name: str, **options) -> DataFrame:
    """Run a catalogue query over the registered views."""
    return QUERIES[name](spark, **options)
