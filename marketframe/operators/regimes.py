"""Macro regimes: classification, the monthly Sharpe panel, and attribution of the premium."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketframe import constants as C
from marketframe.functions import month_end, simple_return, stable_round, stance_label, signed_percent
from marketframe.operators.ordered import Expressions, Segments, by_segment, over_recent_rows
from marketframe.operators.panel import monthly_returns
from marketframe.operators.risk import trailing_sharpe_asof
from marketframe.session import cut_lineage

UNKNOWN = "unknown"


@dataclass(frozen=True)
class Thresholds:
    """Series ids and cut points of the classifier."""

    rate_series: str = "GS10"
    inflation_series: str = "CPIAUCSL"
    unemployment_series: str = "UNRATE"
    funds_series: str = "FEDFUNDS"
    inflation_pct: float = C.INFLATION_HIGH_PCT
    unemployment_pct: float = C.UNEMPLOYMENT_HIGH_PCT
    constant_rate: float = C.RISK_FREE_RATE
    mean_window: int = C.RATE_MEAN_WINDOW
    mean_min_obs: int = C.RATE_MEAN_MIN_OBS

    @property
    def series(self) -> list[str]:
        return [self.rate_series, self.inflation_series, self.unemployment_series, self.funds_series]


def pivot_series(
    macro: DataFrame, series: Sequence[str], load_order: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """One row per date with a column per listed series holding its last non-null value of the date.

    Values of one date are ordered by the columns ``load_order``, such as the extraction time, the file and the position
    in it; only rows equal in all of them fall back on the larger value. Dates on which no listed series has a value give
    no row. The aggregation combines on the map side, and the value list is given, so there is no extra
    pass to discover it.
    """
    known = macro.where(F.col("series_id").isin(*series) & F.col("value").isNotNull())

    def last(name: str) -> Column:
        picked = F.when(F.col("series_id") == name, F.col("value"))
        position = F.when(F.col("series_id") == name, F.struct(*load_order, "value"))
        return F.max_by(picked, position).alias(name)

    return known.groupBy(*by, "date").agg(*[last(name) for name in series])


def classify_regimes(
    wide: DataFrame, thresholds: Thresholds = Thresholds(), region: str | None = None, segments: Segments | None = None
) -> DataFrame:
    """Label each date by rate, inflation and unemployment.

    The rate is compared with its rolling mean, inflation is the 12-row change in percent. A missing
    value never passes a test, so it gets the ordinary label; an absent series gives ``unknown`` and a
    constant funds rate. ``wide`` has one row per date (and region), so without ``segments`` its windows are calendar sized. With the
    ``segments`` of the region along ``date`` a long region is labelled piece by piece, each with the few rows before it.
    """
    t, present = thresholds, set(wide.columns)
    keys = [region] if region else []
    looks_back: Expressions = {}

    if t.rate_series in present:
        rate = F.col(t.rate_series)

        def rolling_mean(ordered: WindowSpec) -> Column:
            recent = ordered.rowsBetween(-(t.mean_window - 1), W.currentRow)
            return F.when(F.count(rate).over(recent) >= t.mean_min_obs, F.avg(rate).over(recent))

        looks_back["__mean"] = rolling_mean
        rate_label = F.when(rate > F.col("__mean"), "rising").otherwise("falling")
    else:
        rate_label = F.lit(UNKNOWN)
    if t.inflation_series in present:
        level = F.col(t.inflation_series)
        looks_back["__change"] = lambda ordered: simple_return(level, F.lag(level, C.MONTHS_PER_YEAR).over(ordered)) * 100
        inflation_label = F.when(F.col("__change") > t.inflation_pct, "high").otherwise("normal")
    else:
        inflation_label = F.lit(UNKNOWN)
    if t.unemployment_series in present:
        jobless = F.col(t.unemployment_series)
        unemployment_label = F.when(jobless > t.unemployment_pct, "elevated").otherwise("normal")
    else:
        unemployment_label = F.lit(UNKNOWN)
    funds = F.col(t.funds_series) if t.funds_series in present else F.lit(t.constant_rate * 100)

    lookback = max(t.mean_window - 1, C.MONTHS_PER_YEAR)
    labelled = over_recent_rows(wide, keys, ["date"], lookback, looks_back, segments).select(
        *keys,
        "date",
        month_end("date").alias("month"),
        rate_label.alias("rate_regime"),
        inflation_label.alias("inflation_regime"),
        unemployment_label.alias("unemployment_regime"),
        funds.alias("fedfunds"),
    )
    parts = ("rate_regime", "inflation_regime", "unemployment_regime")
    return labelled.withColumn("combined_regime", F.concat_ws("_", *parts))


def first_per_month(regimes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Keep the earliest dated regime row of each month (and of each ``by``, such as the region)."""
    columns = [c for c in regimes.columns if c not in ("month", "date", *by)]
    first = F.min_by(F.struct(*columns), F.col("date"))
    return regimes.groupBy(*by, "month").agg(first.alias("r")).select(*by, "month", "r.*")


def monthly_panel(
    prices: DataFrame,
    regimes: DataFrame,
    groups: Mapping[str, Sequence[str]],
    left: str = C.LEFT_GROUP,
    right: str = C.RIGHT_GROUP,
    null_rf: str = "zero",
    wide: bool = True,
) -> DataFrame:
    """One row per month: regime labels, Sharpe per listed symbol, group averages and their difference.

    ``groups`` lists the symbols of the two groups. With ``wide=False`` the per-symbol columns are left
    out, which suits long symbol lists. The regime rows, one per calendar month, are materialised first
    because several parts of the plan read them.
    """
    symbols = [*groups[left], *groups[right]]
    returns = monthly_returns(prices.where(F.col("symbol").isin(*symbols)))
    monthly = cut_lineage(first_per_month(regimes))
    sharpe = trailing_sharpe_asof(returns, monthly, null_rf=null_rf)

    def mean_of(members: Sequence[str]) -> Column:
        return F.avg(F.when(F.col("symbol").isin(*members), F.col("sharpe")))

    per_symbol = [F.max(F.when(F.col("symbol") == s, F.col("sharpe"))).alias(f"{s}_sharpe") for s in symbols]
    averages = sharpe.groupBy("month").agg(
        *(per_symbol if wide else []),
        mean_of(groups[left]).alias("avg_builder_sharpe"),
        mean_of(groups[right]).alias("avg_integrator_sharpe"),
    )
    premium = F.col("avg_builder_sharpe") - F.col("avg_integrator_sharpe")
    return monthly.join(averages, "month").withColumn("builder_premium", premium)


def premium_by_regime(panel: DataFrame) -> DataFrame:
    """Mean Sharpe of both groups and mean premium per combined regime, highest premium first."""
    complete = panel.dropna(subset=["avg_builder_sharpe", "avg_integrator_sharpe"])
    means = ("avg_builder_sharpe", "avg_integrator_sharpe", "builder_premium")
    return (
        complete.groupBy("combined_regime")
        .agg(*[stable_round(F.avg(c), 3).alias(c) for c in means], F.count("month").alias("n_months"))
        .orderBy(F.col("builder_premium").desc_nulls_last(), "combined_regime")
    )


def overall_premium(panel: DataFrame) -> DataFrame:
    """Mean premium over the months that have one."""
    return panel.agg(F.avg("builder_premium").alias("overall_premium"), F.count("builder_premium").alias("n_months"))


def split_regime(summary: DataFrame) -> DataFrame:
    """Chart-side names plus the rate and inflation parts of the combined label."""
    parts = F.split("combined_regime", "_")
    return summary.withColumnsRenamed(
        {"builder_premium": "avg_builder_premium", "n_months": "month_count"}
    ).withColumns({"rate_regime": parts[0], "inflation_regime": parts[1]})


def regime_crosstab(
    summary: DataFrame,
    rates: Sequence[str] = C.RATE_LABELS,
    inflations: Sequence[str] = C.INFLATION_LABELS,
) -> DataFrame:
    """Mean premium and month count on the full rate x inflation label grid, NULL where there is no data."""
    cells = split_regime(summary).groupBy("rate_regime", "inflation_regime").agg(
        F.avg("avg_builder_premium").alias("avg_builder_premium"),
        F.sum("month_count").alias("month_count"),
    )
    pairs = [(r, i) for r in rates for i in inflations]
    grid = summary.sparkSession.createDataFrame(pairs, "rate_regime string, inflation_regime string")
    return grid.join(cells, ["rate_regime", "inflation_regime"], "left")


def stance(summary: DataFrame, cuts: Sequence[float] = C.STANCE_CUTS) -> DataFrame:
    """Decision table: regime text, premium, formatted premium, months and recommended stance."""
    named = split_regime(summary)
    return named.select(
        F.concat_ws(" / ", "rate_regime", "inflation_regime").alias("regime"),
        "combined_regime",
        "avg_builder_premium",
        signed_percent("avg_builder_premium").alias("premium_fmt"),
        "month_count",
        stance_label("avg_builder_premium", cuts).alias("stance"),
    ).orderBy(F.col("avg_builder_premium").desc_nulls_last(), "combined_regime")


def regime_runs(
    panel: DataFrame, drop_last: bool = False, by: Sequence[str] = (), segments: Segments | None = None
) -> DataFrame:
    """Runs of consecutive months with one label: start, the month the next run begins, months.

    The last run ends with its own last month; ``drop_last`` leaves it out. ``panel`` has one row per month and ``by``, so without
    ``segments`` the windows are as long as the calendar. With the ``segments`` of ``by`` along ``month`` a long key is numbered piece by piece; a
    piece whose first label continues the last one of the piece before shares that run.
    """
    rows, keys = by_segment(panel.select(*by, "month", "combined_regime"), by, segments)
    ordered = W.partitionBy(*keys).orderBy("month")
    label = F.col("combined_regime")
    before = F.lag(F.struct(label)).over(ordered)  # a struct tells a missing row from a missing label
    starts = rows.withColumn("starts", (~F.struct(label).eqNullSafe(before)).cast("int"))
    numbered = starts.withColumn("run_id", F.sum("starts").over(ordered))
    if segments is not None:
        numbered = _joined_runs(numbered, by, [k for k in keys if k not in by])
    runs = numbered.groupBy(*by, "run_id", "combined_regime").agg(
        F.min("month").alias("start_month"), F.max("month").alias("last_month"), F.count("*").alias("n_months")
    )
    if segments is None:
        out = runs.withColumn("next_start", F.lead("start_month").over(W.partitionBy(*by).orderBy("run_id")))
    else:  # a long key may have many runs: each meets the one after it by number
        later = runs.select(*[F.col(c).alias(f"__{c}") for c in by], (F.col("run_id") - 1).alias("__run"), F.col("start_month").alias("next_start"))
        same = F.col("run_id") == F.col("__run")
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        out = runs.join(later, same, "left")
    if drop_last:
        out = out.where(F.col("next_start").isNotNull())
    return out.select(
        *by,
        F.col("run_id").cast("bigint").alias("run_id"),
        "combined_regime",
        "start_month",
        F.coalesce("next_start", "last_month").alias("end_month"),
        "n_months",
    )


def _joined_runs(numbered: DataFrame, by: Sequence[str], piece: Sequence[str]) -> DataFrame:
    """Run numbers of pieces turned into those of the whole key: one row per piece decides, with its first and last label and its runs."""
    label = F.struct("combined_regime")
    pieces = numbered.groupBy(*by, *piece).agg(
        F.min_by(label, "month").alias("first"), F.max_by(label, "month").alias("last"), F.max("run_id").alias("n")
    )
    along = W.partitionBy(*by).orderBy(*piece)
    continues = F.coalesce((F.lag("last").over(along).eqNullSafe(F.col("first"))).cast("int"), F.lit(0))
    earlier = along.rowsBetween(W.unboundedPreceding, -1)
    shifted = pieces.withColumn("continues", continues).select(
        *[F.col(c).alias(f"__{c}") for c in (*by, *piece)],
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.sum("continues").over(along)).alias("__shift"),
    )
    same = F.lit(True)
    for c in (*by, *piece):
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return numbered.join(shifted, same).withColumn("run_id", F.col("run_id") + F.col("__shift"))
