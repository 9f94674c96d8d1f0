"""Group comparisons over per-symbol metrics: categories, premiums, spend efficiency, rank correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe import constants as C
from marketframe.functions import build_or_rent, chain_rank, relative_premium, signed_percent, stable_round
from marketframe.operators.ordered import ordinal_rank

_MEASURES = {
    "avg_return": "annualized_return",
    "avg_volatility": "annualized_volatility",
    "avg_sharpe": "sharpe_ratio",
}


def category_stats(metrics: DataFrame, order: Sequence[str] = C.REPORT_ORDER) -> DataFrame:
    """Mean return, volatility and Sharpe with the symbol count per category, in the given order."""
    stats = metrics.groupBy("category").agg(
        *[stable_round(F.avg(col), 3).alias(name) for name, col in _MEASURES.items()],
        F.count("symbol").alias("stock_count"),
    )
    return stats.orderBy(chain_rank("category", order), "category")


def chain_members(metrics: DataFrame, security: DataFrame, order: Sequence[str] = C.CHAIN_ORDER) -> DataFrame:
    """``(rank, category, pos, symbol)`` rows of the categories in ``order``."""
    ranked = metrics.where(F.col("category").isin(*order)).select("symbol", "category")
    placed = ranked.join(security.select("symbol", "pos"), "symbol", "left")
    return placed.select(chain_rank("category", order).alias("rank"), "category", "pos", "symbol")


def value_chain_summary(
    metrics: DataFrame, security: DataFrame, order: Sequence[str] = C.CHAIN_ORDER, listing: bool = False
) -> DataFrame:
    """Ordered category rows with averages; categories outside ``order`` are left out.

    The symbols of a category are the rows of ``chain_members``. With ``listing`` they are also one text cell, in input
    order; this gathers a category in one row, so it is for a dimension known to be small.
    """
    rows = metrics.where(F.col("category").isin(*order))
    measures = [
        stable_round(F.avg("annualized_return"), 2).alias("avg_return"),
        stable_round(F.avg("annualized_volatility"), 2).alias("avg_volatility"),
        stable_round(F.avg("sharpe_ratio"), 3).alias("avg_sharpe"),
        F.count("symbol").alias("stock_count"),
    ]
    if listing:
        rows = rows.join(security.select("symbol", "pos"), "symbol", "left")
        in_order = F.array_sort(F.collect_list(F.struct("pos", "symbol")))
        measures.append(F.array_join(F.transform(in_order, lambda s: s["symbol"]), ", ").alias("stocks"))
    return rows.groupBy("category").agg(*measures).withColumn("rank", chain_rank("category", order)).orderBy("rank")


def group_premium(
    metrics: DataFrame, left: str = C.LEFT_GROUP, right: str = C.RIGHT_GROUP, category: str = "category"
) -> DataFrame:
    """One row comparing two categories; no row when either of them is empty."""

    def of(group: str, col: str):
        return F.avg(F.when(F.col(category) == group, F.col(col)))

    sides = metrics.where(F.col(category).isin(left, right)).agg(
        *[
            of(group, col).alias(f"{side}_{short}")
            for side, group in (("left", left), ("right", right))
            for short, col in (
                ("sharpe", "sharpe_ratio"),
                ("return", "annualized_return"),
                ("vol", "annualized_volatility"),
            )
        ],
        F.count_if(F.col(category) == left).alias("left_count"),
        F.count_if(F.col(category) == right).alias("right_count"),
    )
    present = sides.where((F.col("left_count") > 0) & (F.col("right_count") > 0))
    return present.select(
        "left_sharpe",
        "right_sharpe",
        stable_round(relative_premium(F.col("left_sharpe"), F.col("right_sharpe")), 1).alias("premium_pct"),
        "left_return",
        "right_return",
        (F.col("left_return") - F.col("right_return")).alias("return_gap"),
        "left_vol",
        "right_vol",
        (F.col("left_vol") - F.col("right_vol")).alias("vol_gap"),
    )


def comparison_table(premium: DataFrame) -> DataFrame:
    """Three rows ``(metric, left_value, right_value, premium)`` from a ``group_premium`` row."""
    text = F.concat(F.lit("+"), F.col("premium_pct").cast("string"), F.lit("%"))
    lines = F.array(
        *[
            F.struct(
                F.lit(label).alias("metric"),
                F.col(f"left_{short}").alias("left_value"),
                F.col(f"right_{short}").alias("right_value"),
                (text if short == "sharpe" else F.lit("")).alias("premium"),
            )
            for label, short in (
                ("Sharpe Ratio", "sharpe"),
                ("Annualized Return %", "return"),
                ("Volatility %", "vol"),
            )
        ]
    )
    return premium.select(F.inline(lines))


def premium_text(premium: DataFrame) -> DataFrame:
    """The premium as signed text, negative values keeping their minus sign."""
    return premium.select(signed_percent("premium_pct").alias("premium"))


def spend_efficiency(metrics: DataFrame, spend: DataFrame) -> DataFrame:
    """Sharpe per unit of AI spend (x100) for symbols with spend data; 0 without positive spend."""
    both = metrics.select("symbol", "category", "sharpe_ratio").join(spend, "symbol")
    ai_spend = F.col("capex_2026_B") * F.col("ai_pct") / 100
    efficiency = F.when(ai_spend > 0, F.col("sharpe_ratio") / ai_spend * 100).otherwise(F.lit(0.0))
    return both.select(
        "symbol",
        "category",
        F.col("sharpe_ratio").alias("sharpe"),
        F.col("capex_2026_B").alias("total_capex_2026"),
        "ai_pct",
        stable_round(ai_spend, 1).alias("ai_spend_2026"),
        stable_round(F.try_divide(F.col("capex_2026_B"), F.col("revenue_2025_B")) * 100, 1).alias(
            "capex_to_revenue_pct"
        ),
        stable_round(efficiency, 4).alias("sharpe_per_B"),
        efficiency.alias("efficiency"),
    )


def efficiency_gap(efficiency: DataFrame) -> DataFrame:
    """Most and least efficient symbol and their ratio, 0 when the least is not positive.

    Works on the unrounded ``efficiency`` column; equal values are settled by symbol.
    """
    best = F.min(F.struct((-F.col("efficiency")).alias("key"), F.col("symbol")))
    worst = F.min(F.struct(F.col("efficiency").alias("key"), F.col("symbol")))
    ends = efficiency.where(F.col("efficiency").isNotNull()).agg(best.alias("best"), worst.alias("worst"))
    high, low = -F.col("best.key"), F.col("worst.key")
    return ends.where(F.col("best").isNotNull()).select(
        F.col("best.symbol").alias("most_efficient"),
        stable_round(high, 4).alias("most_value"),
        F.col("worst.symbol").alias("least_efficient"),
        stable_round(low, 4).alias("least_value"),
        stable_round(F.when(low > 0, high / low).otherwise(F.lit(0.0)), 2).alias("efficiency_ratio"),
    )


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = (), key: str = "symbol") -> DataFrame:
    """Rank correlation ``1 - 6 sum(d^2) / (n (n^2 - 1))`` on ordinal ranks, per ``by`` or overall.

    Equal values get consecutive ranks in ``key`` order. 0 for a single row. Both rankings are range
    partitioned, so neither a large group nor a frequent value ends up in one task.
    """
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, key, x, y)
    ranked = ordinal_rank(ordinal_rank(rows, [x, key], "rank_x", by), [y, key], "rank_y", by)
    gap = (F.col("rank_x") - F.col("rank_y")).cast("double")
    stats = ranked.groupBy(*by).agg(F.sum(gap * gap).alias("d2"), F.count("*").cast("double").alias("n"))
    n = F.col("n")
    rho = F.when(n > 1, F.lit(1.0) - F.lit(6.0) * F.col("d2") / (n * (n * n - 1))).otherwise(F.lit(0.0))
    return stats.select(*by, n.cast("bigint").alias("n"), rho.alias("rho"))


def ranked_listing(df: DataFrame, value: str, key: str = "symbol") -> DataFrame:
    """``(rank, key, value)`` rows, highest value first, ties by key."""
    rows = df.where(F.col(value).isNotNull()).select(key, value)
    return ordinal_rank(rows, [F.col(value).desc(), F.col(key).asc()], "rank")


def listing_text(listing: DataFrame, key: str = "symbol", separator: str = " > ") -> DataFrame:
    """The whole listing as one line of text, for report-sized listings."""
    in_order = F.array_sort(F.collect_list(F.struct("rank", key)))
    return listing.agg(F.array_join(F.transform(in_order, lambda s: s[key]), separator).alias("listing"))


def export_master(metrics: DataFrame) -> DataFrame:
    """Metric rows with the build-or-rent label and the chain rank of their category."""
    return metrics.withColumns(
        {"build_or_rent": build_or_rent("category"), "value_chain_rank": chain_rank("category")}
    )


def nest_points(rolling: DataFrame, order: str = "date", value: str = "rolling_sharpe_12m") -> DataFrame:
    """One row per symbol with its points as a date-ordered array, at most one point per period."""
    points = F.array_sort(F.collect_list(F.struct(order, value)))
    return rolling.groupBy("symbol").agg(points.alias("rolling_sharpe"))


def flatten_points(nested: DataFrame, points: str = "rolling_sharpe") -> DataFrame:
    """One row per point; symbols without points give none."""
    rest = [c for c in nested.columns if c != points]
    return nested.select(*rest, F.explode(points).alias("point")).select(*rest, "point.*")
