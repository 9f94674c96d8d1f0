"""Backtest: prices to per-symbol results, and from the results to the exported tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketframe import schemas as S
from marketframe.functions import iso_date
from marketframe.operators import compare
from marketframe.operators.panel import period_returns
from marketframe.operators.quality import assert_nonempty
from marketframe.operators.risk import Rate, risk_metrics, rolling_sharpe
from marketframe.session import cut_lineage
from marketframe.sinks.tables import export_csv, export_json
from marketframe.sources.tables import read_results


def backtest(prices: DataFrame, security: DataFrame, spend: DataFrame, rf: Rate) -> DataFrame:
    """Result records: the metrics of each symbol with its rolling Sharpe points nested.

    The prices, one row per symbol and period, are materialised: metrics and points both read them.
    """
    prices = cut_lineage(prices.select("symbol", "date", "close"))
    metrics = risk_metrics(prices, security, spend, rf)
    rolling = rolling_sharpe(period_returns(prices, drop_missing=True), rf)
    points = compare.nest_points(rolling.withColumn("date", iso_date("date")))
    return metrics.join(points, "symbol", "left").select(*S.RESULTS.names)


def run_backtest(
    prices: DataFrame, security: DataFrame, spend: DataFrame, rf: Rate, out: str
) -> DataFrame:
    """Store the result records below ``out`` and return them as stored.

    The exports read the stored records, so the price history is processed once.
    """
    path = f"{out}/backtest_results_json"
    export_json(backtest(prices, security, spend, rf), path)
    results = read_results(prices.sparkSession, path)
    assert_nonempty(results, "No backtest results generated")
    export_csv(compare.category_stats(results), f"{out}/category_results")
    return results


def analyses(results: DataFrame, security: DataFrame, spend: DataFrame) -> dict[str, DataFrame]:
    """The report tables over result records, by export name."""
    premium = compare.group_premium(results)
    chain = compare.value_chain_summary(results, security, listing=True)  # the dimension is small
    rolling = compare.flatten_points(results.select("symbol", "category", "rolling_sharpe"))
    return {
        "backtest_results": results,
        "export_master": compare.export_master(results),
        "category_summary": chain,
        "build_vs_rent": compare.comparison_table(premium),
        "capex_efficiency": compare.spend_efficiency(results, spend),
        "value_chain_summary": chain,
        "rolling_sharpe": rolling,
    }


def export_analyses(results: DataFrame, security: DataFrame, spend: DataFrame, out: str) -> list[str]:
    """Write each report table as CSV with its fixed column list; tables without rows are not written."""
    frames = analyses(results, security, spend)
    return [name for name, df in frames.items() if export_csv(df, f"{out}/{S.EXPORT_FILES.get(name, name)}", S.EXPORTS[name])]


def ranking_report(results: DataFrame, spend: DataFrame) -> DataFrame:
    """Rank correlation of AI share and Sharpe over the symbols with spend data, with both listings."""
    rows = compare.spend_efficiency(results, spend)
    by_share = compare.listing_text(compare.ranked_listing(rows, "ai_pct")).scalar()
    by_sharpe = compare.listing_text(compare.ranked_listing(rows, "sharpe")).scalar()
    return compare.spearman(rows, "ai_pct", "sharpe").select(
        "n", "rho", by_share.alias("ranked_by_ai_pct"), by_sharpe.alias("ranked_by_sharpe")
    )
