import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import PRICE, months, price_rows, rows
from marketframe import schemas as S
from marketframe.operators.quality import DataQualityError
from marketframe.plans.backtest import export_analyses, run_backtest
from marketframe.operators.risk import risk_free_rate
from marketframe.plans.regime import run_regimes, stored_macro
from marketframe.plans.loads import backfill_prices, load_fundamentals, load_macro, load_quotes
from marketframe.schemas import dims
from marketframe.sources import landed
from marketframe.sources import tables as stored
from test_landed import MACRO, company, docs, filing, quote, write
from test_risk import walk
from marketframe import constants as C


def test_quotes_feed_to_table(spark, path):
    expected = dims(spark).security
    raw = landed.parse_quotes(docs(spark, ("NVDA", quote()), ("META", quote("META", **{"05. price": "620.00"}))))
    first = load_quotes(raw, path("stocks"), "2025-12-31", expected, "2025-12-31T18:00:00")
    assert {r.symbol for r in first.report.where("status = 'failed'").collect()} == set(s for s, *_ in C.SECURITIES) - {"NVDA", "META"}
    load_quotes(raw, path("stocks"), "2025-12-31", expected, "2025-12-31T19:00:00")  # the day is stored already
    out = stored.read_table(spark, S.STOCKS, path("stocks"))
    assert rows(out, "symbol", "price", "change_percent", "date") == [
        ("META", 620.0, 1.79, "2025-12-31"), ("NVDA", 875.4, 1.79, "2025-12-31"),
    ]
    assert {r.timestamp for r in out.collect()} == {"2025-12-31T18:00:00"}


def test_bad_quotes_stop_the_load(spark, path):
    raw = landed.parse_quotes(docs(spark, ("NVDA", quote(**{"05. price": "-5.00"}))))
    with pytest.raises(DataQualityError, match="Invalid price"):
        load_quotes(raw, path("stocks"), "2025-12-31", dims(spark).security)
    assert not Path(path("stocks")).exists()


def test_macro_feed_to_table(spark, path):
    load = load_macro(spark, write(path("m.json"), MACRO), path("macro"), "now")
    assert all(r.valid for r in load.report.collect())
    assert rows(stored.partitions(spark, path("macro"), S.MACRO.keys)) == [("GS10", "2023"), ("UNRATE", "2023")]
    out = stored.scan_series(spark, path("macro"), ["GS10"], (2020, 2026))
    assert rows(out, "series_id", "date", "month", "value") == [("GS10", "2023-01-01", 1, 3.88), ("GS10", "2023-02-01", 2, 3.92)]
    missing = {"GS10": {**MACRO["GS10"], "observations": [{"date": "2023-01-01", "value": "."}]}}
    with pytest.raises(DataQualityError):
        load_macro(spark, write(path("m2.json"), missing), path("macro2"))


def test_fundamentals_feed_to_table(spark, path):
    document = {"META": company("0001326801", **{C.CAPEX_TAG: [filing(2022, 5), filing(2023, 6)], "Revenues": [filing(2022, 9), filing(2023, 4)]})}
    load = load_fundamentals(spark, write(path("x.json"), document), path("f"), "now", table=S.FUNDAMENTALS)
    assert load.report.first().errors == "capex >= revenue: 1 rows"  # reported, not blocking
    assert rows(stored.partitions(spark, path("f"), S.FUNDAMENTALS.keys)) == [("0001326801", "2022"), ("0001326801", "2023")]
    with pytest.raises(DataQualityError):
        load_fundamentals(spark, write(path("y.json"), {"A": company("1")}), path("g"))


def test_price_backfill_replaces_a_symbol(spark, path):
    symbol, expected = F.regexp_extract("path", "([A-Z]+)[.]json", 1), dims(spark).security
    Path(path("in")).mkdir()
    for closes in ((100.0, 105.5, 98.25), (1.0, 2.0, 3.0)):
        body = {f"2023-0{i + 1}-28": {"5. adjusted close": str(c), "6. volume": "7"} for i, c in enumerate(closes)}
        write(path("in/NVDA.json"), {"Monthly Adjusted Time Series": body})
        load = backfill_prices(spark, path("in"), path("p"), symbol, "2024-01-01", expected, stamp="now")
    assert load.report.where("status = 'loaded'").first().symbol == "NVDA"
    assert rows(stored.read_table(spark, S.PRICES, path("p")), "symbol", "close") == [("NVDA", 1.0), ("NVDA", 2.0), ("NVDA", 3.0)]


def test_backtest_from_prices_to_exports(spark, path):
    data = []
    for i, (symbol, *_) in enumerate(C.SECURITIES):
        data += price_rows(symbol, walk(seed=i) if symbol != "CRM" else [100.0] * 5)
    d = dims(spark)
    results = run_backtest(spark.createDataFrame(data, PRICE), d.security, d.spend, 0.045, path("out"))
    assert results.count() == 9  # the short history is left out
    assert {len(r.rolling_sharpe) for r in results.collect()} == {25}
    assert set(export_analyses(results, d.security, d.spend, path("out"))) == set(S.EXPORTS)
    assert spark.read.option("header", True).csv(path("out/rolling_sharpe")).count() == 9 * 25
    with pytest.raises(DataQualityError):
        run_backtest(spark.createDataFrame(price_rows("CRM", [1.0] * 5), PRICE), d.security, d.spend, 0.045, path("none"))


def test_nested_results_survive_the_round_trip(spark, path):
    document = [{"symbol": "META", "category": "AI Builder", "rolling_sharpe": [{"date": "2024-01-01", "rolling_sharpe_12m": 1.5}]}]
    Path(path("r.json")).write_text(json.dumps(document))
    row = stored.read_results(spark, path("r.json"), lines=False).first()
    assert (row.symbol, row.rolling_sharpe[0].date) == ("META", "2024-01-01")


def test_stored_tables_to_regime_summary(spark, path):
    """Landed documents to tables, and from the tables to the rate and the regime summary."""
    observed = months(40, date(2022, 1, 1))
    document = {
        series: {
            "series_id": series, "description": "d", "units": "u",
            "observations": [{"date": d.isoformat(), "value": str(base + step * i)} for i, d in enumerate(observed)],
        }
        for series, base, step in (("GS10", 3.0, 0.05), ("CPIAUCSL", 280.0, 2.0), ("UNRATE", 6.0, 0.0), ("FEDFUNDS", 5.0, 0.0))
    }
    load_macro(spark, write(path("m.json"), document), path("macro"))
    Path(path("in")).mkdir()
    for i, symbol in enumerate(("META", "GOOGL", "MSFT", "AMZN")):
        closes = walk(30, seed=i)
        body = {d.isoformat(): {"5. adjusted close": str(c), "6. volume": "7"} for d, c in zip(months(30, date(2022, 12, 1)), closes)}
        write(path(f"in/{symbol}.json"), {"Monthly Adjusted Time Series": body})
    symbol = F.regexp_extract("path", "([A-Z]+)[.]json", 1)
    backfill_prices(spark, path("in"), path("prices"), symbol, "2026-01-01", dims(spark).security)

    table = stored.read_table(spark, S.MACRO, path("macro"))
    assert risk_free_rate(table).first().rf == pytest.approx(0.05)
    prices = landed.stored_prices(stored.read_table(spark, S.PRICES, path("prices")))
    panel, summary = run_regimes(stored_macro(table), prices, path("out"))
    assert panel.count() == 28  # returns begin in January 2023, macro rows end in April 2025
    assert [(r.combined_regime, r.n_months) for r in summary.collect()] == [("rising_high_elevated", 17)]
