from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import PRICE, months, price_rows, rows
from marketframe.operators import regimes as R
from marketframe.plans.regime import chart_tables, compared_groups, regime_panel, run_regimes

MACRO = "series_id string, date date, value double"


def macro_rows(n=24, unemployment=4.0, yoy=None, funds=4.5):
    out = []
    for i, d in enumerate(months(n)):
        level = 300.0 if yoy is None or i < 12 else 300.0 * (1 + yoy / 100)
        out += [("GS10", d, 3.0 + 0.1 * i), ("CPIAUCSL", d, level), ("UNRATE", d, unemployment), ("FEDFUNDS", d, funds)]
    return out


def classify(spark, data, series=tuple(R.Thresholds().series)):
    return R.classify_regimes(R.pivot_series(spark.createDataFrame(data, MACRO), series, ["date"])).orderBy("date").collect()


def test_rate_needs_six_months_before_it_can_rise(spark):
    labels = [r.rate_regime for r in classify(spark, macro_rows())]
    assert labels[:5] == ["falling"] * 5 and set(labels[5:]) == {"rising"}


def test_inflation_and_unemployment_labels(spark):
    out = classify(spark, macro_rows(unemployment=7.0, yoy=6.0))
    assert {r.inflation_regime for r in out[:12]} == {"normal"} and {r.inflation_regime for r in out[12:]} == {"high"}
    assert {r.unemployment_regime for r in out} == {"elevated"}
    assert out[-1].combined_regime == "rising_high_elevated" and out[0].month == date(2023, 1, 31)
    assert {r.inflation_regime for r in classify(spark, macro_rows(yoy=3.9))} == {"normal"}


def test_absent_series_are_unknown_and_the_rate_is_constant(spark):
    data = [r for r in macro_rows() if r[0] == "GS10"]
    out = classify(spark, data, ["GS10"])
    assert out[-1].combined_regime == "rising_unknown_unknown" and out[-1].fedfunds == pytest.approx(4.5)


def test_missing_values_get_the_ordinary_label(spark):
    data = [(s, d, None if s in ("UNRATE", "CPIAUCSL") and d.month == 5 else v) for s, d, v in macro_rows()]
    out = classify(spark, data)
    assert (out[4].unemployment_regime, out[4].inflation_regime) == ("normal", "normal")


def test_pivot_keeps_the_last_loaded_non_null_value(spark):
    df = spark.createDataFrame(
        [("GS10", date(2024, 1, 1), 1.0, 1), ("GS10", date(2024, 1, 1), 0.5, 2), ("GS10", date(2024, 1, 1), None, 3)],
        MACRO + ", pos int",
    )
    assert R.pivot_series(df, ["GS10"], ["pos"]).first().GS10 == 0.5


def test_first_regime_row_of_a_month_counts(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 31), date(2024, 1, 15), "b"), (date(2024, 1, 31), date(2024, 1, 1), "a")],
        "month date, date date, combined_regime string",
    )
    assert rows(R.first_per_month(df)) == [(date(2024, 1, 31), "a")]


def panel_rows(spark, data):
    return spark.createDataFrame(
        data,
        "month date, combined_regime string, avg_builder_sharpe double, avg_integrator_sharpe double, builder_premium double",
    )


@pytest.fixture(scope="module")
def panel(spark):
    m = months(5, date(2024, 1, 31))
    return panel_rows(
        spark,
        [
            (m[0], "rising_high_normal", 2.0, 1.0, 1.0),
            (m[1], "rising_high_normal", 1.0, 1.0, 0.0),
            (m[2], "falling_normal_normal", 1.0, 2.0, -1.0),
            (m[3], "falling_normal_normal", None, 1.0, None),
            (m[4], "rising_high_normal", 1.0, None, None),
        ],
    )


def test_premium_by_regime_drops_incomplete_months_and_sorts(panel):
    out = R.premium_by_regime(panel).collect()
    assert [(r.combined_regime, r.builder_premium, r.n_months) for r in out] == [
        ("rising_high_normal", 0.5, 2),
        ("falling_normal_normal", -1.0, 1),
    ]
    overall = R.overall_premium(panel).first()
    assert (overall.overall_premium, overall.n_months) == (0.0, 3)


def test_crosstab_keeps_the_whole_grid(panel):
    out = {(r.rate_regime, r.inflation_regime): r for r in R.regime_crosstab(R.premium_by_regime(panel)).collect()}
    assert len(out) == 9
    assert out["rising", "high"].avg_builder_premium == 0.5 and out["rising", "high"].month_count == 2
    assert out["high", "elevated"].avg_builder_premium is None


def test_runs_and_their_last_one(panel):
    out = R.regime_runs(panel).orderBy("run_id").collect()
    assert [(r.combined_regime, r.n_months) for r in out] == [
        ("rising_high_normal", 2), ("falling_normal_normal", 2), ("rising_high_normal", 1),
    ]
    assert out[0].end_month == out[1].start_month and out[2].end_month == out[2].start_month
    assert R.regime_runs(panel, drop_last=True).count() == 2


def test_stance_thresholds_are_strict(spark):
    data = [(f"r{i}_x_y", None, None, p, 1) for i, p in enumerate((50.1, 50.0, 10.0, -10.0, -9.9))]
    summary = spark.createDataFrame(
        data, "combined_regime string, avg_builder_sharpe double, avg_integrator_sharpe double, builder_premium double, n_months bigint"
    )
    out = {r.avg_builder_premium: (r.stance, r.premium_fmt) for r in R.stance(summary).collect()}
    assert out[50.1] == ("Strong Builders", "+50.1%") and out[50.0][0] == "Lean Builders"
    assert out[10.0][0] == "Neutral" and out[-9.9] == ("Neutral", "-9.9%") and out[-10.0][0] == "Lean Integrators"


def prices(spark, n, symbols=("META", "GOOGL", "MSFT", "AMZN")):
    data = []
    for i, s in enumerate(symbols):
        data += price_rows(s, [100 + j * (i + 1) + (j % (i + 2)) for j in range(n)])
    return spark.createDataFrame(data, PRICE)


def test_panel_is_all_null_with_six_months_and_complete_with_more(spark):
    macro = spark.createDataFrame(macro_rows(36), MACRO)
    short = regime_panel(macro, prices(spark, 6), load_order=["date"]).collect()
    assert len(short) == 5 and all(r.builder_premium is None for r in short)
    full = regime_panel(macro, prices(spark, 30), load_order=["date"]).orderBy("month").collect()
    assert len(full) == 29 and full[-1].builder_premium is not None
    assert full[-1].avg_builder_sharpe == pytest.approx((full[-1].META_sharpe + full[-1].GOOGL_sharpe) / 2)


def test_absent_symbol_is_a_null_column_and_left_out_of_the_mean(spark):
    macro = spark.createDataFrame(macro_rows(36), MACRO)
    last = regime_panel(macro, prices(spark, 30, ("META", "MSFT", "AMZN")), load_order=["date"]).orderBy(F.desc("month")).first()
    assert last.GOOGL_sharpe is None and last.avg_builder_sharpe == pytest.approx(last.META_sharpe)


def test_no_macro_series_at_all_raises(spark):
    with pytest.raises(ValueError):
        regime_panel(spark.createDataFrame([], MACRO), prices(spark, 20), load_order=["date"])


def test_run_stores_panel_summary_and_chart_tables(spark, path):
    panel, summary = run_regimes(spark.createDataFrame(macro_rows(36), MACRO), prices(spark, 30), path("out"), load_order=["date"])
    assert panel.count() == 29 and summary.agg(F.sum("n_months")).first()[0] == 18
    assert spark.read.option("header", True).csv(path("out/regime_summary_csv")).count() == summary.count()
    assert {name: df.count() for name, df in chart_tables(panel, summary).items()}["heatmap"] == 9
    assert compared_groups() == {"AI Builder": ["META", "GOOGL"], "AI Integrator": ["MSFT", "AMZN"]}


def test_regions_are_classified_and_followed_separately(spark):
    data = [(region, s, d, v if region == "east" else v + 3.0) for region in ("east", "west") for s, d, v in macro_rows()]
    macro = spark.createDataFrame(data, "region string, " + MACRO)
    wide = R.pivot_series(macro, R.Thresholds().series, ["date"], by=["region"])
    labels = R.classify_regimes(wide, region="region")
    monthly = R.first_per_month(labels, ["region"])
    assert monthly.count() == 48
    got = {(r.region, r.unemployment_regime) for r in monthly.collect()}
    assert got == {("east", "normal"), ("west", "elevated")}
    runs = R.regime_runs(monthly, by=["region"]).where("region = 'west'").orderBy("run_id").collect()
    assert [r.combined_regime for r in runs] == ["falling_normal_elevated", "rising_normal_elevated"]


@pytest.mark.parametrize("rare", [False, True])
def test_runs_of_a_key_that_holds_all_rows(spark, rare):
    """Cut into pieces, the runs are those of one pass, also when a run spans several pieces or a label is missing."""
    from marketframe.operators.ordered import find_segments

    labels = [None if i % 97 == 0 else ("a" if rare and i % 400 else "abc"[i * 7919 % 11 % 3]) for i in range(3000)]
    expected, previous = [], object()
    for i, label in enumerate(labels):
        if label != previous:
            if expected:
                expected[-1][3] = i
            expected.append([len(expected) + 1, label, i, i, 0])
        expected[-1][4] += 1
        if i == len(labels) - 1:
            expected[-1][3] = i
        previous = label
    data = [("west", i, label) for i, label in enumerate(labels)] + [(None, 1, "a"), ("east", 1, "b"), ("east", 2, "b")]
    panel = spark.createDataFrame(data, "region string, month int, combined_regime string").repartition(8)
    segments = find_segments(panel, ["region"], ["month"])
    assert segments is not None and segments.longest > 2
    runs = R.regime_runs(panel, by=["region"], segments=segments)
    columns = ("run_id", "combined_regime", "start_month", "end_month", "n_months")
    assert rows(runs.where("region = 'west'"), *columns) == sorted(map(tuple, expected), key=repr)
    assert rows(runs.where("region = 'east' OR region IS NULL"), "region", *columns) == [("east", 1, "b", 1, 2, 2), (None, 1, "a", 1, 1, 1)]
    assert rows(R.regime_runs(panel, by=["region"])) == rows(runs)
    assert R.regime_runs(panel, True, ["region"], segments).count() == len(expected) - 1


def test_labels_of_a_key_that_holds_nearly_all_rows(spark):
    """Cut into pieces, rolling mean and yearly change see the same rows as in one pass, also across cuts and missing values."""
    from datetime import timedelta

    from marketframe.operators.ordered import find_segments

    first, rate, level = date(2000, 1, 1), [], []
    for i in range(2000):
        rate.append(None if i % 31 == 5 else float(i * 7919 % 101))
        level.append(None if i % 53 == 9 else 100.0 + i * 31 % 17)
    data = [("west", first + timedelta(i), rate[i], level[i], float(i % 9)) for i in range(2000)]
    data += [("east", first + timedelta(i), 1.0 + i, 100.0, 4.0) for i in range(9)] + [(None, first, 1.0, 1.0, 9.0)]
    wide = spark.createDataFrame(data, "region string, date date, GS10 double, CPIAUCSL double, UNRATE double").repartition(8)
    segments = find_segments(wide, ["region"], ["date"])
    assert segments is not None and segments.longest > 2
    labels = R.classify_regimes(wide, region="region", segments=segments)
    assert rows(labels) == rows(R.classify_regimes(wide, region="region"))
    t = R.Thresholds()
    for r in labels.where("region = 'west'").collect():
        i = (r.date - first).days
        recent = [x for x in rate[max(0, i - t.mean_window + 1) : i + 1] if x is not None]
        rising = rate[i] is not None and len(recent) >= t.mean_min_obs and rate[i] > sum(recent) / len(recent)
        before = level[i - 12] if i >= 12 else None
        high = None not in (level[i], before) and (level[i] / before - 1) * 100 > t.inflation_pct
        assert (r.rate_regime, r.inflation_regime) == ("rising" if rising else "falling", "high" if high else "normal"), r
