from pathlib import Path
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import rows
from marketframe.operators import freshness, quality

QUOTE = "symbol string, price double, volume bigint, change_percent double"


def errors(spark, *data):
    return [r.error for r in quality.check_quotes(spark.createDataFrame(list(data), QUOTE)).collect()]


def test_quote_rules(spark):
    assert errors(spark, ("A", 10.0, 5, 1.0), ("B", 1.0, 0, 50.0)) == []
    assert errors(spark, ("A", -5.0, 1, 0.0)) == ["A: Invalid price: $-5.0"]
    assert errors(spark, ("A", 0.0, 1, 0.0)) == ["A: Invalid price: $0.0"]
    assert errors(spark, ("A", None, 1, 0.0)) == ["A: Missing required field: price", "A: Invalid price: $0"]
    assert errors(spark, ("A", 1.0, -500, 0.0)) == ["A: Invalid volume: -500"]
    assert errors(spark, ("A", 1.0, 1, 75.0), ("B", 1.0, 1, -50.5)) == ["A: Suspicious change: 75.0%", "B: Suspicious change: -50.5%"]
    assert errors(spark, (None, 1.0, 1, 0.0)) == ["UNKNOWN: Missing required field: symbol"]


def test_a_missing_column_counts_as_missing_on_every_row(spark):
    df = spark.createDataFrame([("A", 1.0, 1, 0.0)], QUOTE).drop("volume")
    assert [r.error for r in quality.check_quotes(df).collect()] == ["A: Missing required field: volume"]


def test_blocking_check(spark, path):
    good = spark.createDataFrame([("A", 1.0, 1, 0.0)], QUOTE)
    assert quality.assert_quotes(good, path("none")) is good and not Path(path("none")).exists()
    with pytest.raises(quality.DataQualityError, match="No stock data"):
        quality.assert_quotes(good.limit(0), path("none"))
    bad = spark.range(30).select(F.concat(F.lit("S"), "id").alias("symbol"), F.lit(-1.0).alias("price"), F.lit(1).cast("bigint").alias("volume"), F.lit(0.0).alias("change_percent"))
    with pytest.raises(quality.DataQualityError, match="Invalid price: 30; all errors are in"):
        quality.assert_quotes(bad, path("errors"))
    assert spark.read.parquet(path("errors")).count() == 30


def test_macro_rules(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 1), 4.5, "GS10"), (date(2024, 1, 1), 20.0, "CPIAUCSL"), (None, 5.33, "FEDFUNDS"), (date(2024, 1, 1), 25.0, "FEDFUNDS"), (date(2024, 1, 1), 1e9, "OTHER")],
        "date date, value double, series_id string",
    )
    got = {r.series_id: r for r in quality.check_macro(df, quality.macro_ranges(spark)).collect()}
    assert got["GS10"].valid and got["OTHER"].valid
    assert got["CPIAUCSL"].errors == "CPIAUCSL value out of range [100, 400]: 1 rows"
    assert got["FEDFUNDS"].errors == "Null values in date column" and got["FEDFUNDS"].row_count == 2
    none = df.withColumn("series_id", F.lit(None).cast("string"))
    assert quality.check_macro(none, quality.macro_ranges(spark)).first().errors.endswith("Null values in series_id column")
    short = quality.check_macro(df.drop("value"), quality.macro_ranges(spark)).first()
    assert not short.valid and "value" in short.errors and short.row_count == 5


def test_fundamentals_rules(spark):
    def check(*data):
        return quality.check_fundamentals(spark.createDataFrame(list(data), "symbol string, year int, capex double, revenue double")).first()

    assert check(("A", 2023, 50e9, 200e9)).valid
    assert check(("A", 2023, -1.0, 200e9)).errors == "capex < 0: 1 rows"
    assert check(("A", 2023, 0.0, 0.0)).errors == "revenue <= 0: 1 rows; capex >= revenue: 1 rows"
    assert check(("A", 2023, 300e9, 200e9)).capex_exceeds_revenue == 1
    assert check((None, None, 1.0, 2.0)).errors == "Null values in symbol column; Null values in year column"
    only_null = check(("A", 2023, 1.0, None))
    assert only_null.valid and only_null.row_count == 0
    missing = quality.check_fundamentals(spark.createDataFrame([("A", 1)], "symbol string, year int")).first()
    assert not missing.valid and "capex" in missing.errors


def test_load_report_and_guards(spark):
    expected = spark.createDataFrame([("A",), ("B",)], "symbol string")
    assert rows(quality.load_report(expected, expected.where("symbol = 'A'"))) == [("A", "loaded"), ("B", "failed")]
    with pytest.raises(quality.DataQualityError):
        quality.assert_nonempty(expected.limit(0), "nothing")
    with pytest.raises(quality.DataQualityError):
        quality.require_columns(expected, ["symbol", "price"])
    assert quality.record_counts(expected).first().records == 2


FILE = "day date, path string, modified timestamp, symbol string, price double"


def test_completeness(spark):
    monday, tuesday, wednesday, saturday = (date(2026, 3, d) for d in (2, 3, 4, 7))
    data = [(monday, "new", datetime(2026, 3, 2, 10), f"S{i}", float(i)) for i in range(10)]
    data += [(monday, "old", datetime(2026, 3, 2, 9), "S0", 99.0)]
    data += [(tuesday, "f", datetime(2026, 3, 3, 9), "S0", 1.0)]
    days = spark.createDataFrame([(d,) for d in (monday, tuesday, wednesday, saturday)], "day date")
    got = {r.day: r for r in freshness.completeness(spark.createDataFrame(data, FILE), days).collect()}
    assert got[monday].status == "OK" and got[monday].prices == {f"S{i}": float(i) for i in range(10)}
    assert (got[tuesday].status, got[tuesday].message, got[tuesday].prices) == ("ERROR", "Expected 10 stocks, got 1", None)
    assert (got[wednesday].status, got[wednesday].message) == ("WARNING", "No data for 2026-03-04")
    assert (got[saturday].status, got[saturday].message) == ("OK", "Saturday - non-trading day")


def test_staleness_and_health(spark):
    files = spark.createDataFrame(
        [("fundamentals", "a", datetime(2026, 1, 1)), ("fundamentals", "b", datetime(2026, 2, 1)), ("macro_indicators", "c", datetime(2026, 1, 1))],
        "feed string, path string, modified timestamp",
    )
    report = freshness.staleness(files, "2026-02-06 00:00:00", freshness.default_limits(spark))
    got = {r.feed: r for r in report.collect()}
    assert (got["fundamentals"].status, got["fundamentals"].partitions, got["fundamentals"].days_since_update) == ("OK", 2, 5)
    assert got["macro_indicators"].message == "Data is 36 days old (expected <=35)"
    missing = freshness.staleness(files.limit(0), "2026-02-06", freshness.default_limits(spark))
    assert {r.message for r in missing.collect()} == {"No fundamentals data found", "No macro_indicators data found"}
    state = freshness.health([report]).first()
    assert (state.health, state.n_issues) == ("NEEDS_ATTENTION", 1)
    assert freshness.health([report.where("status = 'OK'")]).first().health == "HEALTHY"
