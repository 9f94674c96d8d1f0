"""Risk metrics per symbol: return, volatility, Sharpe (headline, rolling, as-of), drawdown, beta."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketframe import constants as C
from marketframe.functions import (
    annualised_return,
    annualised_volatility,
    excess_sharpe,
    headline_sharpe,
    iso_date,
    simple_return,
    stable_round,
)
from marketframe.operators.ordered import Segments, over_recent_rows
from marketframe.operators.panel import max_drawdown, period_returns
from marketframe.session import broadcast_if_small, cut_lineage

Rate = float | Column | DataFrame


def as_scalar(rate: Rate) -> Column:
    """A number, a column, or a one-row one-column frame read as a scalar subquery."""
    if isinstance(rate, DataFrame):
        return rate.scalar()
    return rate if isinstance(rate, Column) else F.lit(float(rate))


def risk_free_rate(
    macro: DataFrame,
    series: str = "FEDFUNDS",
    years: tuple[int, int] = C.RATE_YEARS,
    fallback: float = C.RISK_FREE_RATE,
) -> DataFrame:
    """One row ``rf``: the mean of the series in percent / 100, or the fallback when it has no values."""
    picked = macro.where((F.col("series_id") == series) & F.col("year").between(*years))
    return picked.agg(F.coalesce(F.avg("value") / 100, F.lit(fallback)).alias("rf"))


def raw_metrics(prices: DataFrame, min_obs: int = C.MIN_RETURNS, segments: Segments | None = None) -> DataFrame:
    """Unrounded metrics, one row per symbol with at least ``min_obs`` returns.

    Returns and running peaks share one window partitioning, and the aggregate reuses it. A symbol has one
    price per period, so a window partition is no longer than the calendar. For finer prices, where one
    symbol may hold most rows, pass ``segments``: then both parts work on pieces of a symbol.
    """
    series = prices.select("symbol", "date", "close")
    if segments is None:
        ordered = W.partitionBy("symbol").orderBy("date")
        peak = F.max("close").over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow))
        series = series.withColumns(
            {"ret": simple_return(F.col("close"), F.lag("close").over(ordered)), "peak": peak}
        )
        fall = F.min((F.col("close") - F.col("peak")) / F.col("peak"))
        drawdown = [F.when(F.count("close") < 2, F.lit(0.0)).otherwise(fall).alias("drawdown")]
    else:
        series, drawdown = period_returns(series, segments=segments), []
    observations = F.count("ret")
    metrics = series.groupBy("symbol").agg(
        annualised_return(F.avg("ret"), observations, min_obs).alias("ann_return"),
        annualised_volatility(F.stddev_samp("ret")).alias("ann_vol"),
        *drawdown,
        observations.alias("months_analyzed"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )
    if segments is not None:
        metrics = metrics.join(max_drawdown(prices, name="drawdown", segments=segments), "symbol")
    return metrics.where(F.col("months_analyzed") >= min_obs)


def risk_metrics(
    prices: DataFrame,
    security: DataFrame,
    spend: DataFrame | None = None,
    rf: Rate = C.RISK_FREE_RATE,
    min_obs: int = C.MIN_RETURNS,
    segments: Segments | None = None,
) -> DataFrame:
    """Report row per symbol: annualised return and volatility, Sharpe, drawdown, coverage, attributes.

    ``security`` adds category and strategy, ``spend`` the spending columns; both are left lookups.
    """
    rate = as_scalar(rf)
    metrics = raw_metrics(prices, min_obs, segments).select(
        "symbol",
        stable_round(F.col("ann_return") * 100, 2).alias("annualized_return"),
        stable_round(F.col("ann_vol") * 100, 2).alias("annualized_volatility"),
        stable_round(headline_sharpe(F.col("ann_return"), F.col("ann_vol"), rate), 3).alias("sharpe_ratio"),
        stable_round(F.col("drawdown") * 100, 2).alias("max_drawdown"),
        "months_analyzed",
        iso_date("first_date").alias("start_date"),
        iso_date("last_date").alias("end_date"),
    )
    out = metrics.join(security.select("symbol", "category", "ai_strategy"), "symbol", "left")
    if spend is None:
        return out
    spending = spend.select(
        "symbol",
        "capex_2025_B",
        "capex_2026_B",
        F.col("ai_pct").alias("ai_pct_of_capex"),
        stable_round(F.col("capex_2026_B") * F.col("ai_pct") / 100, 1).alias("est_ai_spend_2026_B"),
    )
    return out.join(spending, "symbol", "left")


def _window_moments(returns: DataFrame, order: str, n: int, segments: Segments | None) -> DataFrame:
    """Count, mean and sample deviation of the last ``n`` returns of each symbol."""

    def frame(spec: W) -> W:
        return spec.rowsBetween(-(n - 1), W.currentRow)

    return over_recent_rows(
        returns,
        ["symbol"],
        [order],
        n - 1,
        {
            "n_obs": lambda w: F.count("ret").over(frame(w)),
            "mean": lambda w: F.avg("ret").over(frame(w)),
            "deviation": lambda w: F.stddev_samp("ret").over(frame(w)),
        },
        segments,
    )


def rolling_sharpe(
    returns: DataFrame,
    rf: Rate = C.RISK_FREE_RATE,
    n: int = C.ROLLING_WINDOW,
    order: str = "date",
    name: str = "rolling_sharpe_12m",
    segments: Segments | None = None,
) -> DataFrame:
    """Sharpe of every full window of ``n`` returns, rounded to three digits, at the window's last date.

    ``returns`` holds one row per symbol and period with a non-null ``ret``.
    """
    rate = as_scalar(rf)
    moments = _window_moments(returns.where(F.col("ret").isNotNull()), order, n, segments)
    return moments.where(F.col("n_obs") == n).select(
        "symbol", order, stable_round(excess_sharpe(F.col("mean"), F.col("deviation"), rate), 3).alias(name)
    )


def trailing_sharpe(
    returns: DataFrame,
    rf: Rate,
    n: int = C.ROLLING_WINDOW,
    order: str = "month",
    name: str = "trailing_sharpe",
    segments: Segments | None = None,
) -> DataFrame:
    """Unrounded trailing Sharpe on every row: NULL before the first full window, 0 without volatility."""
    rate = as_scalar(rf)
    moments = _window_moments(returns, order, n, segments)
    value = F.when(F.col("n_obs") == n, excess_sharpe(F.col("mean"), F.col("deviation"), rate))
    return moments.withColumn(name, value).drop("n_obs", "mean", "deviation")


def trailing_sharpe_asof(
    returns: DataFrame, regimes: DataFrame, n: int = C.ROLLING_WINDOW, null_rf: str = "zero"
) -> DataFrame:
    """Trailing Sharpe of each symbol in each regime month, from its latest ``n`` returns up to that month.

    The months are those with any return that also have a regime row. ``fedfunds`` of the regime row is the
    annual rate in percent; without it the result is 0 (``null_rf='zero'``) or NULL (``'null'``).

    A symbol's window moments stay valid until its next return, so each return row is spread over the
    months it covers and matched to the spine by equality. Before its first return a symbol has a row
    with a NULL Sharpe. Output: ``(symbol, month, sharpe)`` for every symbol and spine month.
    ``regimes`` has one row per month and is read several times: pass it stored or materialised.
    """
    if null_rf not in ("zero", "null"):
        raise ValueError("null_rf must be 'zero' or 'null'")
    # One row per symbol and month, read for the months and for the moments: computed once.
    returns = cut_lineage(returns.select("symbol", "month", "ret"))
    spine = regime_spine(returns, regimes).withColumn("place", _month_number("month"))
    ends = regimes.agg(F.min(_month_number("month")).alias("first"), F.max(_month_number("month")).alias("last"))

    moments = _window_moments(returns, "month", n, None)
    ordered = W.partitionBy("symbol").orderBy("month")
    own = _month_number("month")
    until = F.coalesce(_month_number(F.lead("month").over(ordered)) - 1, ends.select("last").scalar())
    # The first return also covers the months before it, with no moments yet.
    is_first = F.lag("month").over(ordered).isNull()
    since = F.when(is_first, F.least(ends.select("first").scalar(), own)).otherwise(own)
    covered = moments.withColumns({"own": own, "since": since, "until": until})
    places = F.when(F.col("since") <= F.col("until"), F.sequence("since", "until"))
    cells = covered.select("symbol", "own", "n_obs", "mean", "deviation", F.explode(places).alias("place"))
    rate = F.col("fedfunds") / 100
    usable = (F.col("n_obs") == n) & (F.col("place") >= F.col("own"))
    missing = F.lit(0.0) if null_rf == "zero" else F.lit(None).cast("double")
    value = F.when(
        usable,
        F.when(F.col("fedfunds").isNull(), missing).otherwise(excess_sharpe(F.col("mean"), F.col("deviation"), rate)),
    )
    months = broadcast_if_small(spine, rows_of=regimes)
    return cells.join(months, "place").select("symbol", "month", value.alias("sharpe"))


def _month_number(month: Column | str) -> Column:
    """Months since year 0, so that a span of months is a range of integers."""
    month = F.col(month) if isinstance(month, str) else month
    return F.year(month) * 12 + F.month(month)


def regime_spine(returns: DataFrame, regimes: DataFrame) -> DataFrame:
    """Regime rows of the months in which any symbol has a return: at most one row per calendar month."""
    return regimes.join(returns.select("month").distinct(), "month", "left_semi")


def beta(stock: DataFrame, market: DataFrame, min_obs: int = C.MIN_RETURNS, strict_length: bool = True) -> DataFrame:
    """Covariance of symbol and market returns over the market variance, per symbol.

    NULL below ``min_obs`` pairs, for a market without variance and, with ``strict_length``, when the
    symbol's series and the market's differ in length. The market, one row per month, is materialised and
    counted, so that the symbols' returns need no shuffle by month.
    """
    other = cut_lineage(market.select("month", F.col("ret").alias("market_ret")))
    pairs = stock.select("symbol", "month", "ret").join(broadcast_if_small(other), "month", "left")
    stats = pairs.groupBy("symbol").agg(
        F.count("ret").alias("n_stock"),
        F.count(F.when(F.col("ret").isNotNull(), F.col("market_ret"))).alias("n_pairs"),
        F.covar_samp("ret", "market_ret").alias("cov"),
        F.var_samp(F.when(F.col("ret").isNotNull(), F.col("market_ret"))).alias("var"),
    )
    usable = (F.col("n_pairs") >= min_obs) & (F.col("var") != 0)
    if strict_length:
        market_length = other.agg(F.count("market_ret")).scalar()
        usable = usable & (F.col("n_stock") == market_length) & (F.col("n_pairs") == market_length)
    return stats.select("symbol", "n_pairs", F.when(usable, F.col("cov") / F.col("var")).alias("beta"))
