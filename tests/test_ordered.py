from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helpers import rows
from marketframe.operators.ordered import find_segments, first_per_key, ordinal_rank
from marketframe.operators.panel import max_drawdown, period_returns, rolling_mean
from marketframe.operators.risk import raw_metrics, rolling_sharpe
from marketframe.functions import stable_round


@pytest.fixture(scope="module")
def skewed(spark):
    """One symbol holds most rows; another is small; times repeat now and then."""
    rng = np.random.default_rng(5)
    data, start = [], datetime(2024, 1, 1)
    for symbol, n in (("HOT", 3000), ("WARM", 200), ("COLD", 7), ("ONE", 1)):
        for i in range(n):
            at = start + timedelta(seconds=int(rng.integers(0, n)))
            data.append((symbol, at, i, float(np.round(rng.uniform(1, 100), 2))))
    return spark.createDataFrame(data, "symbol string, date timestamp, id bigint, close double").repartition(8)


@pytest.fixture(scope="module")
def segments(skewed):
    found = find_segments(skewed, ["symbol"], ["date", "id"])
    assert [r.symbol for r in found.bounds.collect()] == ["HOT"]
    tagged = found.tag(skewed).where("symbol = 'HOT'").groupBy("__segment").count().collect()
    assert len(tagged) == 15 and max(r["count"] for r in tagged) < 600
    return found


def one_per_time(df):
    return df.groupBy("symbol", "date").agg(F.max("close").alias("close"))


def test_no_segments_without_a_hot_key(spark, skewed):
    assert find_segments(skewed, ["id"], ["date", "symbol"]) is None
    assert find_segments(skewed.limit(0), ["symbol"], ["date", "id"]) is None


def test_a_key_is_cut_into_as_many_pieces_as_the_share_asks_for(skewed):
    """More than 512 pieces, and every row in the piece its place in the order says."""
    found = find_segments(skewed, ["symbol"], ["date", "id"], share=0.005)
    tagged = [r for r in found.tag(skewed).where("symbol = 'HOT'").orderBy("date", "id").collect()]
    numbers = [r["__segment"] for r in tagged]
    assert found.longest > 1000 and numbers == sorted(numbers) and len(set(numbers)) > 1000


@pytest.mark.parametrize("n", [2, 3, 40])
def test_segmented_rolling_mean_equals_the_plain_window(skewed, segments, n):
    plain = rolling_mean(skewed, "symbol", ["date", "id"], "close", n, 2)
    split = rolling_mean(skewed, "symbol", ["date", "id"], "close", n, 2, segments=segments)
    assert split.columns == plain.columns
    value = stable_round("rolling_mean", 6).alias("m")
    assert rows(split, "symbol", "id", value) == rows(plain, "symbol", "id", value)


@pytest.mark.parametrize("lookback", [5, 400])
def test_edges_reach_back_over_several_small_segments(skewed, lookback):
    """A lookback longer than a segment takes rows from more than one of them."""
    split = find_segments(skewed, ["symbol"], ["date", "id"], share=0.12)
    plain = period_returns(skewed, "symbol", ["date", "id"], "close", lag=lookback)
    cut = period_returns(skewed, "symbol", ["date", "id"], "close", lag=lookback, segments=split)
    assert rows(cut, "symbol", "id", "ret") == rows(plain, "symbol", "id", "ret")


@pytest.fixture(scope="module")
def panel(skewed):
    return one_per_time(skewed)


@pytest.fixture(scope="module")
def panel_segments(panel):
    return find_segments(panel, ["symbol"], ["date"])


def test_segmented_drawdown_equals_the_plain_one(panel, panel_segments):
    assert rows(max_drawdown(panel, segments=panel_segments)) == rows(max_drawdown(panel))


def test_segmented_rolling_sharpe_equals_the_plain_one(panel, panel_segments):
    returns = panel.withColumn("ret", F.col("close") / 100)
    assert rows(rolling_sharpe(returns, segments=panel_segments)) == rows(rolling_sharpe(returns))


def test_segmented_metrics_equal_the_plain_ones(panel, panel_segments):
    def report(segments):
        out = raw_metrics(panel, segments=segments)
        return rows(out.select("symbol", "months_analyzed", *[stable_round(c, 6).alias(c) for c in ("ann_return", "ann_vol", "drawdown")]))

    assert report(panel_segments) == report(None) and len(report(None)) == 2


def test_a_key_whose_rows_share_one_time_is_still_cut(spark):
    """Half of the rows on one day: the rest of the order separates them."""
    df = spark.range(4000).select(
        F.lit("HOT").alias("symbol"),
        F.when(F.col("id") < 3900, "2024-01-01").otherwise("2024-01-02").alias("date"),
        F.format_string("%05d", F.pmod(F.col("id") * 7919, F.lit(4000))).alias("stamp"),
        (F.col("id") % 100).cast("double").alias("close"),
    )
    df = df.unionByName(df.limit(100).withColumn("symbol", F.lit("COLD")))
    segments = find_segments(df, ["symbol"], ["date", "stamp"])
    sizes = [r["count"] for r in segments.tag(df).where("symbol = 'HOT'").groupBy("__segment").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 600
    plain = rolling_mean(df, "symbol", ["date", "stamp"], "close", 3)
    cut = rolling_mean(df, "symbol", ["date", "stamp"], "close", 3, segments=segments)
    value = stable_round("rolling_mean", 6).alias("m")
    assert rows(cut, "symbol", "stamp", value) == rows(plain, "symbol", "stamp", value)


def test_first_per_key_limits_before_the_shuffle(skewed, capsys):
    out = first_per_key(skewed, ["symbol"], [F.col("date").desc(), F.col("id")])
    out.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out
    assert out.count() == 4


def test_ordinal_rank_whole_table_and_per_group_with_heavy_ties(spark):
    df = spark.range(5000).select(
        F.col("id"), (F.col("id") % 3).alias("v"), F.when(F.col("id") < 4000, "big").otherwise("small").alias("g")
    ).repartition(16)
    whole = ordinal_rank(df, ["v", "id"], "rank")
    expected = df.withColumn("rank", F.row_number().over(W.orderBy("v", "id")).cast("bigint"))
    assert rows(whole, "id", "rank") == rows(expected, "id", "rank")
    grouped = ordinal_rank(df, [F.col("v").desc(), "id"], "rank", by=["g"])
    expected = df.withColumn("rank", F.row_number().over(W.partitionBy("g").orderBy(F.col("v").desc(), "id")).cast("bigint"))
    assert rows(grouped, "id", "rank") == rows(expected, "id", "rank")


@pytest.mark.parametrize(("value", "digits", "expected"), [(0.00049996, 3, 0.0), (0.0005, 3, 0.001), (2.675, 2, 2.68), (1.005, 2, 1.01), (-0.125, 2, -0.13), (0.1249999999, 2, 0.12)])
def test_rounding_moves_only_values_at_a_tie(spark, value, digits, expected):
    assert spark.range(1).select(stable_round(F.lit(value), digits)).first()[0] == expected


def test_rounding_does_not_depend_on_the_order_of_a_sum(spark):
    sums = [0.1 + 0.2 + 0.7 + 0.005, 0.005 + 0.7 + 0.2 + 0.1, 0.2 + 0.005 + 0.1 + 0.7]
    got = {spark.range(1).select(stable_round(F.lit(v), 2)).first()[0] for v in sums}
    assert got == {1.01}
