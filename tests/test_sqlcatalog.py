import pytest

from helpers import rows
from marketframe.plans import sqlcatalog
from marketframe.functions import stable_round
from marketframe.operators.panel import rolling_mean

STOCK = "symbol string, trading_day string, price double, volume bigint, change_percent double, timestamp string"


@pytest.fixture(scope="module")
def views(spark):
    spark.createDataFrame(
        [
            ("NVDA", "2026-01-05", 100.0, 10, 1.0, "t1"),
            ("NVDA", "2026-01-05", 101.0, 30, 2.0, "t2"),
            ("NVDA", "2026-01-06", 103.0, 10, None, "t3"),
            ("META", "2026-01-05", 600.0, 5, 3.0, "t1"),
            ("AAPL", "2026-01-06", 200.0, 7, -1.0, "t1"),
        ],
        STOCK,
    ).createOrReplaceTempView("stocks")
    spark.createDataFrame([("BTC", 50.0), ("BTC", 100.0), ("ETH", 10.0)], "symbol string, price double").createOrReplaceTempView("crypto")
    spark.createDataFrame([("Rome", 10.0), ("Oslo", 15.5)], "city string, temperature double").createOrReplaceTempView("weather")
    return spark


def run(views, name, **options):
    return [tuple(r) for r in sqlcatalog.run(views, name, **options).collect()]


def test_daily_leader(views):
    assert run(views, "daily_leader") == [("AAPL", "2026-01-06", -1.0), ("META", "2026-01-05", 3.0)]


def test_asset_summary(views):
    assert sorted(run(views, "asset_summary")) == [("Crypto", 2, 53.33), ("Stocks", 3, 220.8), ("Weather", 1, 12.75)]


def test_change_spread_needs_two_rows(views):
    assert run(views, "change_spread") == [("NVDA", 3, 1.0, 2.0, 1.0)]


def test_moving_average(views):
    out = run(views, "moving_average")
    assert [(s, p, m) for s, _, p, m in out if s == "NVDA"] == [("NVDA", 100.0, 100.0), ("NVDA", 101.0, 100.5), ("NVDA", 103.0, 101.33)]


def test_moving_average_of_a_symbol_cut_into_segments(views):
    spark = views
    hot = spark.range(2000).selectExpr(
        "CASE WHEN id % 10 < 8 THEN 'HOT' ELSE concat('S', id % 10) END AS symbol", "'2026-01-05' AS trading_day",
        "CAST(id % 37 AS DOUBLE) AS price", "id AS volume", "0D AS change_percent", "format_string('%06d', id) AS timestamp",
    )
    kept = spark.table("stocks")
    hot.createOrReplaceTempView("stocks")
    try:
        cut = rows(sqlcatalog.run(spark, "moving_average", keep=("timestamp",)))
        plain = rolling_mean(spark.table("stocks"), "symbol", ["trading_day", "timestamp"], "price", 3, name="mean")
        expected = plain.select("timestamp", "symbol", "trading_day", "price", stable_round("mean", 2).alias("moving_avg_3d"))
        assert cut == rows(expected) and len(cut) == 2000
    finally:
        kept.createOrReplaceTempView("stocks")


def test_high_volume(views):
    assert run(views, "high_volume") == [("NVDA", "2026-01-05", 101.0, 30, 2.0, 17.0, 1.8)]


def test_price_range(views):
    assert run(views, "price_range") == [("BTC", 50.0, 100.0, 50.0, 100.0), ("ETH", 10.0, 10.0, 0.0, 0.0)]


def test_category_performance_uses_the_newest_row(views):
    out = {r[0]: r[1:] for r in run(views, "category_performance")}
    assert out["Infrastructure"] == (2.0, 20.0, 1) and out["AI Builder"] == (3.0, 5.0, 1) and out["Control"] == (-1.0, 7.0, 1)


def test_dollar_volume_is_ordered_by_traded_value(views):
    out = run(views, "dollar_volume")
    assert [(r[0], r[1]) for r in out] == [("NVDA", 101.0), ("META", 600.0), ("AAPL", 200.0), ("NVDA", 103.0)]
    assert len(rows(sqlcatalog.run(views, "dollar_volume"))) == 4
