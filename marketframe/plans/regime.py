"""Regime attribution: macro series and prices to the monthly panel, its summary and chart tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe import constants as C
from marketframe.functions import parse_date
from marketframe.operators import regimes as R
from marketframe.operators.quality import assert_nonempty
from marketframe.sinks.tables import export_csv, replace


def stored_macro(table: DataFrame) -> DataFrame:
    """The stored macro table with its ISO text date as DATE, and when each row was extracted."""
    return table.select("series_id", parse_date("date").alias("date"), "value", "extracted_at")


def compared_groups() -> dict[str, list[str]]:
    """Symbols of the two compared categories."""
    return {
        group: [symbol for symbol, category, _ in C.SECURITIES if category == group]
        for group in (C.LEFT_GROUP, C.RIGHT_GROUP)
    }


def regime_panel(
    macro: DataFrame,
    prices: DataFrame,
    groups: Mapping[str, Sequence[str]] | None = None,
    thresholds: R.Thresholds = R.Thresholds(),
    load_order: Sequence[str] = ("extracted_at",),
) -> DataFrame:
    """The monthly panel from long macro rows and prices.

    A series without any value is left out of the pivot, which makes its label ``unknown``.
    """
    wanted = F.col("series_id").isin(*thresholds.series) & F.col("value").isNotNull()
    present = {row.series_id for row in macro.where(wanted).select("series_id").distinct().collect()}
    listed = [s for s in thresholds.series if s in present]
    if not listed:
        raise ValueError("No macro data loaded for any of the series")
    wide = R.pivot_series(macro, listed, load_order)
    return R.monthly_panel(prices, R.classify_regimes(wide, thresholds), groups or compared_groups())


def run_regimes(
    macro: DataFrame,
    prices: DataFrame,
    out: str,
    groups: Mapping[str, Sequence[str]] | None = None,
    thresholds: R.Thresholds = R.Thresholds(),
    load_order: Sequence[str] = ("extracted_at",),
) -> tuple[DataFrame, DataFrame]:
    """Store panel and summary as Parquet and CSV below ``out``; both are returned as stored."""
    spark = macro.sparkSession
    replace(regime_panel(macro, prices, groups, thresholds, load_order), f"{out}/regime_analysis")
    panel = spark.read.parquet(f"{out}/regime_analysis")
    assert_nonempty(panel, "No monthly data produced: macro and price dates do not meet")
    replace(R.premium_by_regime(panel), f"{out}/regime_summary")
    summary = spark.read.parquet(f"{out}/regime_summary")
    export_csv(panel.orderBy("month"), f"{out}/regime_analysis_csv")
    export_csv(summary, f"{out}/regime_summary_csv")
    return panel, summary


def chart_tables(panel: DataFrame, summary: DataFrame) -> dict[str, DataFrame]:
    """The data behind each chart: grid, bars, shaded series with its mean, decision table."""
    bars = R.split_regime(summary).orderBy(F.col("avg_builder_premium").asc_nulls_last(), "combined_regime")
    return {
        "heatmap": R.regime_crosstab(summary),
        "bar_chart": bars,
        "time_series": panel.select("month", "builder_premium").orderBy("month"),
        "regime_runs": R.regime_runs(panel, drop_last=True),
        "overall": R.overall_premium(panel),
        "decision_matrix": R.stance(summary),
    }
