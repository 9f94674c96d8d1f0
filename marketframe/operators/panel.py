"""Series operators on a symbol-by-time panel: returns, rolling means, peaks and drawdowns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketframe.functions import month_end, simple_return
from marketframe.operators.ordered import Segments, by_segment, over_recent_rows


def names(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def period_returns(
    prices: DataFrame,
    by: str | Sequence[str] = "symbol",
    order: str | Sequence[str] = "date",
    value: str = "close",
    lag: int = 1,
    name: str = "ret",
    scale: float = 1.0,
    drop_missing: bool = False,
    segments: Segments | None = None,
) -> DataFrame:
    """Change against the ``lag``-th earlier **row** of the same key, times ``scale``."""

    def change(spec: W) -> Column:
        ratio = simple_return(F.col(value), F.lag(value, lag).over(spec))
        return ratio if scale == 1.0 else ratio * F.lit(float(scale))

    out = over_recent_rows(prices, names(by), names(order), lag, {name: change}, segments)
    return out.where(F.col(name).isNotNull()) if drop_missing else out


def monthly_returns(prices: DataFrame, segments: Segments | None = None) -> DataFrame:
    """``(symbol, month, ret)`` labelled with the month end; the first row of a symbol has no return."""
    returns = period_returns(prices.select("symbol", "date", "close"), drop_missing=True, segments=segments)
    return returns.select("symbol", month_end("date").alias("month"), "ret")


def rolling_mean(
    df: DataFrame,
    by: str | Sequence[str],
    order: str | Sequence[str],
    value: str,
    n: int,
    min_obs: int = 1,
    name: str = "rolling_mean",
    segments: Segments | None = None,
) -> DataFrame:
    """Mean of the last ``n`` rows, NULL until ``min_obs`` of them hold a value."""

    def mean(spec: W) -> Column:
        frame = spec.rowsBetween(-(n - 1), W.currentRow)
        return F.when(F.count(value).over(frame) >= min_obs, F.avg(value).over(frame))

    return over_recent_rows(df, names(by), names(order), n - 1, {name: mean}, segments)


def running_peak(df: DataFrame, by: str | Sequence[str], order: str | Sequence[str], value: str) -> DataFrame:
    """Running maximum from the first row of the key."""
    spec = W.partitionBy(*names(by)).orderBy(*names(order)).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn("peak", F.max(value).over(spec))


def max_drawdown(
    prices: DataFrame,
    by: str | Sequence[str] = "symbol",
    order: str | Sequence[str] = "date",
    value: str = "close",
    name: str = "max_drawdown",
    segments: Segments | None = None,
) -> DataFrame:
    """Largest fall from a running peak as a fraction (<= 0), 0.0 for fewer than two prices.

    A segment needs only its own drawdown, lowest and highest price: under a peak ``P`` carried in from
    earlier segments every ratio becomes ``min(price / own peak, price / P)``, whose minimum is
    ``min(own drawdown, lowest / P - 1)``.
    """
    by = names(by)
    tagged, fine = by_segment(prices.select(*by, *names(order), value), by, segments)
    peaked = running_peak(tagged, fine, order, value)
    pieces = peaked.groupBy(*fine).agg(
        F.min((F.col(value) - F.col("peak")) / F.col("peak")).alias("own"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.count(value).alias("n"),
    )
    if segments is not None:
        earlier = W.partitionBy(*by).orderBy(fine[-1]).rowsBetween(W.unboundedPreceding, -1)
        carried = F.max("high").over(earlier)
        under = pieces.withColumn("own", F.least("own", (F.col("low") - carried) / carried))
        pieces = under.groupBy(*by).agg(F.min("own").alias("own"), F.sum("n").alias("n"))
    return pieces.select(*by, F.when(F.col("n") < 2, F.lit(0.0)).otherwise(F.col("own")).alias(name))
