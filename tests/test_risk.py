import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import PRICE, RETURN, months, price_rows, rows
from marketframe.operators import risk
from marketframe.operators.panel import max_drawdown, monthly_returns, period_returns, rolling_mean
from marketframe.schemas import dims


def walk(n=37, seed=42):
    steps = np.random.default_rng(seed).normal(0.02, 0.08, n - 1)
    return 100 * np.concatenate([[1.0], np.cumprod(1 + steps)])


def returns_frame(spark, values, symbol="A"):
    return spark.createDataFrame([(symbol, d, float(v)) for d, v in zip(months(len(values)), values)], RETURN)


def test_metrics_of_a_seeded_walk_match_a_direct_computation(spark):
    closes = walk()
    prices = spark.createDataFrame(price_rows("META", closes), PRICE)
    d = dims(spark)
    row = risk.risk_metrics(prices, d.security, d.spend, 0.045).first()
    r = closes[1:] / closes[:-1] - 1
    annual, vol = (1 + r.mean()) ** 12 - 1, r.std(ddof=1) * math.sqrt(12)
    peak = np.maximum.accumulate(closes)
    assert row.annualized_return == pytest.approx(round(annual * 100, 2), abs=0.01)
    assert row.annualized_volatility == pytest.approx(round(vol * 100, 2), abs=0.01)
    assert row.sharpe_ratio == pytest.approx((annual - 0.045) / vol, abs=0.001)
    assert row.max_drawdown == pytest.approx(((closes - peak) / peak).min() * 100, abs=0.01)
    assert (row.months_analyzed, row.start_date, row.end_date) == (36, "2023-01-01", "2026-01-01")
    assert (row.category, row.est_ai_spend_2026_B, row.ai_pct_of_capex) == ("AI Builder", 118.8, 95)


def test_symbols_without_spend_have_missing_spend_columns(spark):
    prices = spark.createDataFrame(price_rows("NVDA", walk()), PRICE)
    d = dims(spark)
    row = risk.risk_metrics(prices, d.security, d.spend).first()
    assert row.capex_2026_B is None and row.category == "Infrastructure"


def test_short_history_is_dropped_and_flat_history_has_no_sharpe(spark):
    short = price_rows("CRM", [100, 105, 103, 110, 108, 115, 112])
    flat = price_rows("ORCL", [100.0] * 25)
    out = risk.risk_metrics(spark.createDataFrame(short + flat, PRICE), dims(spark).security).collect()
    assert [r.symbol for r in out] == ["ORCL"]
    assert out[0].sharpe_ratio == 0.0 and out[0].annualized_volatility == 0.0


def test_steady_growth_and_decline(spark):
    up = price_rows("AAPL", [100 * 1.05**i for i in range(13)])
    down = price_rows("TSLA", [100 * 0.97**i for i in range(37)])
    got = {r.symbol: r for r in risk.risk_metrics(spark.createDataFrame(up + down, PRICE), dims(spark).security).collect()}
    assert got["AAPL"].annualized_return == pytest.approx(79.59, abs=0.01)
    assert got["AAPL"].annualized_volatility < 0.01 and got["AAPL"].sharpe_ratio > 0
    assert got["TSLA"].annualized_return < 0 and got["TSLA"].sharpe_ratio < 0


def test_one_percent_a_month_compounds_arithmetically(spark):
    prices = spark.createDataFrame(price_rows("NVDA", [100 * 1.01**i for i in range(13)]), PRICE)
    assert risk.raw_metrics(prices).first().ann_return == pytest.approx(1.01**12 - 1, abs=1e-9)
    assert risk.raw_metrics(spark.createDataFrame(price_rows("NVDA", [100 * 1.01**i for i in range(12)]), PRICE)).isEmpty()


@pytest.mark.parametrize("closes, expected", [([100, 90, 65, 80, 95], -0.35), ([100, 110, 120], 0.0), ([100], 0.0), ([100, 50, 100, 25], -0.75)])
def test_drawdown(spark, closes, expected):
    out = max_drawdown(spark.createDataFrame(price_rows("A", closes), PRICE)).first()
    assert out.max_drawdown == pytest.approx(expected)


def test_rolling_sharpe_lengths_values_and_zero_excess(spark):
    for n, points in ((11, 0), (12, 1), (24, 13)):
        values = np.random.default_rng(n).normal(0.01, 0.05, n)
        out = risk.rolling_sharpe(returns_frame(spark, values), 0.043, order="month").orderBy("month").collect()
        assert len(out) == points
        for i, row in enumerate(out):
            excess = values[i : i + 12] - 0.043 / 12
            assert row.rolling_sharpe_12m == pytest.approx(excess.mean() / excess.std(ddof=1) * math.sqrt(12), abs=6e-4)
    flat = risk.rolling_sharpe(returns_frame(spark, [0.01] * 12), 0.12, order="month").first()
    assert flat.rolling_sharpe_12m == 0.0


def test_walk_of_37_prices_has_25_rolling_points(spark):
    returns = period_returns(spark.createDataFrame(price_rows("META", walk()), PRICE), drop_missing=True)
    assert risk.rolling_sharpe(returns).count() == 25


def test_trailing_sharpe_is_null_before_a_full_window(spark):
    values = list(np.random.default_rng(1).normal(0.01, 0.05, 14))
    out = risk.trailing_sharpe(returns_frame(spark, values), 0.03).orderBy("month").collect()
    assert [r.trailing_sharpe is None for r in out] == [True] * 11 + [False] * 3


def test_beta(spark):
    values = np.random.default_rng(3).normal(0.01, 0.05, 12)
    market = returns_frame(spark, values / 2, "M")
    assert risk.beta(returns_frame(spark, values), market).first().beta == pytest.approx(2.0)
    assert risk.beta(returns_frame(spark, values / 2), market).first().beta == pytest.approx(1.0)
    assert risk.beta(returns_frame(spark, values[:11]), returns_frame(spark, values[:11], "M")).first().beta is None
    longer = returns_frame(spark, np.append(values, 0.1))
    assert risk.beta(longer, market).first().beta is None
    assert risk.beta(longer, market, strict_length=False).first().beta == pytest.approx(2.0)
    assert risk.beta(returns_frame(spark, values), returns_frame(spark, [0.0] * 12, "M")).first().beta is None


def test_risk_free_rate_and_fallback(spark):
    macro = spark.createDataFrame(
        [("FEDFUNDS", 2023, 4.5), ("FEDFUNDS", 2024, 5.5), ("FEDFUNDS", 2024, None), ("FEDFUNDS", 2019, 9.0), ("GS10", 2023, 1.0)],
        "series_id string, year bigint, value double",
    )
    assert risk.risk_free_rate(macro).first().rf == pytest.approx(0.05)
    assert risk.risk_free_rate(macro.where("series_id = 'GS10'")).first().rf == 0.045


def test_returns_are_labelled_with_the_month_end(spark):
    out = monthly_returns(spark.createDataFrame(price_rows("A", [100, 110, 99]), PRICE))
    assert rows(out.select("month", F.round("ret", 6))) == [(date(2023, 2, 28), 0.1), (date(2023, 3, 31), -0.1)]


def test_zero_previous_price_gives_no_return(spark):
    out = period_returns(spark.createDataFrame(price_rows("A", [0, 5, 10]), PRICE)).orderBy("date").collect()
    assert [r.ret for r in out] == [None, None, 1.0]


def test_rolling_mean_counts_only_present_values(spark):
    values = [None, 1.0, 2.0, None, 3.0, 4.0]
    df = spark.createDataFrame([("A", d, v) for d, v in zip(months(6), values)], PRICE)
    out = rolling_mean(df, "symbol", "date", "close", 4, 2).orderBy("date").collect()
    assert [r.rolling_mean for r in out] == [None, None, 1.5, 1.5, 2.0, 3.0]


def _reference_cells(returns, regimes, null_rf):
    """Brute force over months and symbols."""
    by_symbol = {}
    for symbol, month, ret in returns:
        by_symbol.setdefault(symbol, []).append((month, ret))
    months_with_returns = {m for _, m, _ in returns}
    cells = {}
    for month, funds in regimes:
        if month not in months_with_returns:
            continue
        for symbol, series in by_symbol.items():
            past = [r for m, r in sorted(series) if m <= month][-12:]
            value = None
            if len(past) == 12:
                if funds is None:
                    value = 0.0 if null_rf == "zero" else None
                else:
                    excess = np.array(past) - funds / 1200
                    deviation = excess.std(ddof=1)
                    value = float(excess.mean() / deviation * math.sqrt(12)) if deviation > 0 else 0.0
            cells[symbol, month] = value
    return cells


@pytest.mark.parametrize("seed, null_rf", [(0, "zero"), (1, "null"), (2, "zero")])
def test_asof_sharpe_equals_brute_force_on_panels_with_gaps(spark, seed, null_rf):
    rng = np.random.default_rng(seed)
    spark_months = [r.m for r in spark.createDataFrame([(d,) for d in months(40)], "d date").select(F.last_day("d").alias("m")).collect()]
    returns = []
    for symbol, keep, first in (("A", 1.0, 0), ("B", 0.6, 3), ("C", 0.8, 20), ("D", 0.3, 0), ("E", 1.0, 35)):
        for m in spark_months[first:]:
            if rng.random() < keep:
                returns.append((symbol, m, float(rng.normal(0.01, 0.05))))
    regimes = [
        (m, None if rng.random() < 0.15 else float(rng.uniform(0, 5))) for m in spark_months[2:38] if rng.random() < 0.9
    ]
    out = risk.trailing_sharpe_asof(
        spark.createDataFrame(returns, RETURN), spark.createDataFrame(regimes, "month date, fedfunds double"), null_rf=null_rf
    )
    got = {(r.symbol, r.month): r.sharpe for r in out.collect()}
    expected = _reference_cells(returns, regimes, null_rf)
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert got[key] == (None if value is None else pytest.approx(value, abs=1e-9)), key
