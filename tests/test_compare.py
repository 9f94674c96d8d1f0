from pathlib import Path

import pytest

from helpers import rows
from marketframe import schemas as S
from marketframe.operators import compare
from marketframe.plans.backtest import analyses, export_analyses, ranking_report
from marketframe.schemas import dims
from marketframe.sources.tables import read_csv
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FIXTURES = Path(__file__).parent / "fixtures"
NUMBER = dict(abs=0.0011)


@pytest.fixture(scope="module")
def golden(spark):
    schema = StructType([S.RESULTS[c] for c in S.EXPORTS["backtest_results"]])
    return read_csv(spark, str(FIXTURES / "golden_metrics.csv"), schema).cache()


# The published category averages.
CHAIN = {
    "Infrastructure": (1, "NVDA", 131.52, 43.67, 2.92, 1),
    "AI Builder": (2, "META, GOOGL", 63.07, 31.34, 1.871, 2),
    "AI Integrator": (3, "MSFT, AMZN", 29.52, 24.65, 0.995, 2),
    "Control": (4, "AAPL, TSLA", 41.82, 38.86, 1.006, 2),
    "Legacy Tech": (5, "CRM, ORCL, ADBE", 12.21, 37.41, 0.192, 3),
}


def test_value_chain_summary(spark, golden):
    out = compare.value_chain_summary(golden, dims(spark).security, listing=True).collect()
    assert [r.category for r in out] == list(CHAIN)
    for r in out:
        rank, stocks, ret, vol, sharpe, n = CHAIN[r.category]
        assert (r["rank"], r.stocks, r.stock_count) == (rank, stocks, n)
        assert r.avg_return == pytest.approx(ret, abs=0.011) and r.avg_volatility == pytest.approx(vol, abs=0.011)
        assert r.avg_sharpe == pytest.approx(sharpe, **NUMBER)


def test_category_stats_are_in_report_order(golden):
    out = compare.category_stats(golden).collect()
    assert [r.category for r in out] == ["Infrastructure", "AI Builder", "AI Integrator", "Legacy Tech", "Control"]
    assert out[3].avg_return == pytest.approx(12.213, **NUMBER)


def test_group_premium_and_comparison_table(golden):
    premium = compare.group_premium(golden)
    row = premium.first()
    assert (row.left_sharpe, row.right_sharpe, row.premium_pct) == (pytest.approx(1.8715), pytest.approx(0.995), 88.1)
    table = {r.metric: r for r in compare.comparison_table(premium).collect()}
    assert table["Sharpe Ratio"].premium == "+88.1%"
    assert table["Annualized Return %"].left_value == pytest.approx(63.075)
    assert table["Volatility %"].right_value == pytest.approx(24.65) and table["Volatility %"].premium == ""


def test_premium_needs_both_groups_and_guards_a_zero_denominator(spark, golden):
    assert compare.group_premium(golden.where("category <> 'AI Builder'")).isEmpty()
    zero = golden.withColumn("sharpe_ratio", F.when(F.col("category") == "AI Integrator", 0.0).otherwise(F.col("sharpe_ratio")))
    assert compare.group_premium(zero).first().premium_pct == 0.0
    sample = spark.createDataFrame(
        [("AI Builder", 2.174), ("AI Integrator", 1.372)], "category string, sharpe_ratio double"
    ).withColumns({"annualized_return": F.lit(1.0), "annualized_volatility": F.lit(1.0)})
    assert compare.group_premium(sample).first().premium_pct == 58.5
    losing = compare.group_premium(sample, "AI Integrator", "AI Builder")
    assert compare.premium_text(losing).first().premium == "-36.9%"


def test_spend_efficiency_gap_and_rank_correlation(spark, golden):
    spend = dims(spark).spend
    efficiency = compare.spend_efficiency(golden, spend)
    got = {r.symbol: (r.ai_spend_2026, r.capex_to_revenue_pct, r.sharpe_per_B) for r in efficiency.collect()}
    assert got == {
        "META": (118.8, 66.5, 1.6758),
        "GOOGL": (144.0, 51.4, 1.2174),
        "MSFT": (87.0, 55.3, 0.7034),
        "AMZN": (80.0, 31.3, 1.7225),
    }
    gap = compare.efficiency_gap(efficiency).first()
    assert (gap.most_efficient, gap.least_efficient, gap.efficiency_ratio) == ("AMZN", "MSFT", 2.45)
    report = ranking_report(golden, spend).first()
    assert report.rho == pytest.approx(0.8) and report.n == 4
    assert report.ranked_by_ai_pct == "META > GOOGL > MSFT > AMZN"
    assert report.ranked_by_sharpe == "META > GOOGL > AMZN > MSFT"


def test_efficiency_gap_is_zero_when_the_least_is_not_positive(spark):
    df = spark.createDataFrame([("A", 2.0), ("B", 2.0), ("C", -1.0)], "symbol string, efficiency double")
    gap = compare.efficiency_gap(df).first()
    assert (gap.most_efficient, gap.efficiency_ratio) == ("A", 0.0)


def test_spearman_extremes(spark):
    df = spark.createDataFrame([("A", 1, 3), ("B", 2, 2), ("C", 3, 1)], "symbol string, x int, y int")
    assert compare.spearman(df, "x", "y").first().rho == -1.0
    assert compare.spearman(df, "x", "x").first().rho == 1.0
    assert compare.spearman(df.where("symbol = 'A'"), "x", "y").first().rho == 0.0


def test_export_master_labels(golden):
    got = {r.symbol: (r.build_or_rent, r.value_chain_rank) for r in compare.export_master(golden).collect()}
    assert got["META"] == ("Build", 2) and got["MSFT"] == ("Rent", 3) and got["NVDA"] == ("N/A", 1)
    odd = golden.limit(1).withColumn("category", F.lit("Other"))
    assert compare.export_master(odd).first().value_chain_rank == 99


def test_nest_and_flatten(spark):
    points = spark.createDataFrame(
        [("META", "2024-02-01", 1.2), ("META", "2024-01-01", 1.1), ("MSFT", "2024-01-01", 0.5)],
        "symbol string, date string, rolling_sharpe_12m double",
    )
    nested = compare.nest_points(points)
    assert nested.where("symbol = 'META'").first().rolling_sharpe[0].date == "2024-01-01"
    absent = nested.limit(1).select(F.lit("CRM").alias("symbol"), F.lit(None).cast(nested.schema["rolling_sharpe"].dataType).alias("rolling_sharpe"))
    assert rows(compare.flatten_points(nested.union(absent))) == rows(points)


def test_exports_have_their_columns_and_empty_ones_are_not_written(spark, golden, path):
    d = dims(spark)
    results = golden.withColumn("rolling_sharpe", F.lit(None).cast(S.RESULTS["rolling_sharpe"].dataType))
    written = export_analyses(results, d.security, d.spend, path("out"))
    assert set(written) == set(S.EXPORTS) - {"rolling_sharpe"}
    assert not Path(path("out/rolling_sharpe")).exists()
    for name in written:
        headings = S.EXPORTS[name]
        written_to = path(f"out/{S.EXPORT_FILES.get(name, name)}")
        assert spark.read.option("header", True).csv(written_to).columns == list(headings.values() if isinstance(headings, dict) else headings)
    again = spark.read.option("header", True).option("escape", '"').csv(path("out/backtest_results"))
    assert "Proprietary (Llama, MTIA chips)" in [r.ai_strategy for r in again.collect()]
    assert set(analyses(results, d.security, d.spend)) == set(S.EXPORTS)
