"""The registered queries: every operator over whole tables derived from the driver's data."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from marketframe import constants as C
from marketframe import schemas as S
from marketframe.functions import iso_date, stable_round
from marketframe.operators import compare, freshness, quality, regimes, risk
from marketframe.operators.fundamentals import annual_only, fundamentals
from marketframe.operators.ordered import first_per_key
from marketframe.operators.panel import max_drawdown, monthly_returns, period_returns, rolling_mean
from marketframe.plans import backtest, loads, regime, sqlcatalog
from marketframe.session import cut_lineage, scratch_path
from marketframe.sinks import snapshots
from marketframe.sinks import tables as sinks
from marketframe.sources import landed
from marketframe.sources import tables as stored
from marketframe.streaming.ingest import ingest_available_now
from marketframe.workload import documents as D
from marketframe.workload import tables as T

STAMP = "2024-02-01T00:00:00"
AS_OF = "2024-02-15 12:00:00"
RATE_SPAN = (1996, 2000)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name, or under the name it stands for."""
    QUERIES[_NAMES.get(fn.__name__, fn.__name__)] = fn
    return fn


# Functions whose query name is taken by an imported operator.
_NAMES = {
    "company_fundamentals": "fundamentals",
    "period_return": "monthly_returns",
    "drawdown": "max_drawdown",
    "regime_labels": "regimes",
    "regime_stance": "stance",
}


# --- shared inputs ------------------------------------------------------------------------------


def _returns(spark, sf):
    return period_returns(T.prices(spark, sf), drop_missing=True)


def _rate(spark, sf):
    return risk.risk_free_rate(T.macro(spark, sf), years=RATE_SPAN)


def _metrics(spark, sf, with_spend=False):
    return risk.risk_metrics(
        T.prices(spark, sf), T.security(spark, sf), T.known_spend(spark, sf) if with_spend else None, rf=_rate(spark, sf)
    )


def _regimes(spark, sf):
    wide = regimes.pivot_series(T.macro(spark, sf), T.THRESHOLDS.series, ["date"])
    return regimes.classify_regimes(wide, T.THRESHOLDS)


# Brands per compared group (brand number modulo five is 1 or 2).
GROUPS = {
    C.LEFT_GROUP: [f"Brand#{n}" for n in (1, 6, 11, 16, 21)],
    C.RIGHT_GROUP: [f"Brand#{n}" for n in (2, 7, 12, 17, 22)],
}


def _panel(spark, sf, wide=False):
    return regimes.monthly_panel(T.prices(spark, sf), _regimes(spark, sf), GROUPS, wide=wide)


def _summary(spark, sf):
    return regimes.premium_by_regime(_panel(spark, sf))


# --- landed documents ---------------------------------------------------------------------------


@query
def quote_normalise(spark, sf):
    raw = landed.parse_quotes(D.quote_documents(spark, sf))
    return landed.normalise_quotes(raw, STAMP).select(
        "quote_id", "symbol", "price", "change_percent", "volume", "trading_day", "timestamp",
        stable_round("previous_close", 6).alias("previous_close"), stable_round("change", 6).alias("change"),
    )


@query
def macro_parse(spark, sf):
    parsed = landed.parse_macro(D.macro_documents(spark, sf))
    return landed.macro_records(parsed, STAMP).withColumn("value", stable_round("value", 6))


@query
def macro_missing_counts(spark, sf):
    return landed.macro_missing_counts(landed.parse_macro(D.macro_documents(spark, sf)))


@query
def xbrl_annual(spark, sf):
    tags = [T.CAPEX_TAG, *T.REVENUE_TAGS]
    return annual_only(landed.parse_xbrl(D.filing_documents(spark, sf), tags), tags, T.MIN_YEAR).drop("pos")


@query
def company_fundamentals(spark, sf):
    annual = annual_only(T.filings(spark, sf))
    return fundamentals(annual, T.CAPEX_TAG, T.REVENUE_TAGS, T.MIN_YEAR, STAMP)


@query
def prices_clean(spark, sf):
    rows = landed.parse_monthly(D.monthly_documents(spark, sf), "1996-01-01", "2000-12-31", STAMP)
    return rows.withColumn("close", stable_round("close", 6))


@query
def prices_from(spark, sf):
    feed = T.prices(spark, sf).withColumnsRenamed({"date": "Date", "close": "Close"})
    return landed.clean_prices(feed, "1997-06-30").withColumn("close", stable_round("close", 6))


# --- stored tables ------------------------------------------------------------------------------


def _macro_table(spark, sf):
    m = T.macro(spark, sf)
    return m.select(
        "series_id", "description", "units", iso_date("date").alias("date"), "month", "value",
        F.lit(STAMP).alias("extracted_at"), F.col("series_id").alias("series"), F.col("year").cast("string").alias("year"),
    )


def _stored_macro(spark, root):
    rows = stored.read_table(spark, S.MACRO, root)
    return rows.select("series", "year", "date", "month", stable_round("value", 6).alias("value"))


@query
def series_scan(spark, sf):
    root = scratch_path(spark, "series_scan")
    sinks.write_table(_macro_table(spark, sf), root, S.MACRO)
    rows = stored.scan_series(spark, root, ["GS10", "UNRATE", "NOT_THERE"], (1997, 1999))
    return rows.select("series", "year", "date", stable_round("value", 6).alias("value"))


@query
def partition_roundtrip(spark, sf):
    root, rows = scratch_path(spark, "roundtrip"), _macro_table(spark, sf)
    sinks.write_table(rows, root, S.MACRO)
    late = rows.where(F.col("year") >= "2000").withColumn("value", F.col("value") + 1)
    sinks.write_table(late, root, S.MACRO)
    return _stored_macro(spark, root)


@query
def skip_existing(spark, sf):
    root, rows = scratch_path(spark, "skip"), _macro_table(spark, sf)
    sinks.write_table(rows.where(F.col("year") < "1999"), root, S.MACRO, sinks.SKIP)
    sinks.write_table(rows.withColumn("value", F.col("value") + 1), root, S.MACRO, sinks.SKIP)
    return _stored_macro(spark, root)


@query
def incremental_load(spark, sf):
    """Two streamed loads of new files, then batch writes to the same table: append, skip, overwrite and the partition list."""
    source, root, checkpoint = (scratch_path(spark, label) for label in ("landing", "stocks", "progress"))
    rows = T.quotes(spark, sf).select("kind", *S.STOCKS.columns.names)
    for early in (True, False):
        batch = rows.where(F.col("kind").isin("CLICK", "VIEW") == early).drop("kind")
        batch.write.mode("append").json(source)
        ingest_available_now(
            spark, source, root, S.STOCKS, checkpoint, S.STOCKS.columns,
            lambda df: df.withColumn("date", F.col("trading_day")),
        )
    whole = rows.drop("kind").withColumn("date", F.col("trading_day"))
    sinks.write_table(whole, root, S.STOCKS, sinks.APPEND)
    sinks.write_table(whole, root, S.STOCKS, sinks.SKIP)  # every day is there
    late = whole.where(F.col("date") >= whole.agg(F.max("date")).scalar())
    sinks.write_table(late, root, S.STOCKS, sinks.OVERWRITE)
    listed = stored.partitions(spark, root, S.STOCKS.keys)
    return _stock_totals(stored.read_table(spark, S.STOCKS, root).join(listed, "date", "left_semi"))


def _stock_totals(loaded):
    return loaded.groupBy("date", "symbol").agg(
        F.count("*").alias("n"), F.sum("volume").alias("volume"), stable_round(F.sum("price"), 4).alias("price")
    )


@query
def load_quotes_run(spark, sf):
    """Landed quote records through the load into the catalog, read back by SQL."""
    landing, root = scratch_path(spark, "quotes"), scratch_path(spark, "stocks")
    text = [F.col(c).cast("string").alias(c) for c in ("symbol", "price", "volume", "trading_day", "previous_close", "change", "change_percent")]
    good = T.quotes(spark, sf).where("price > 0 AND volume >= 0 AND abs(change_percent) <= 50")
    good.select(*text).write.json(landing)
    name = f"stocks_{root[-32:]}"
    loads.load_quotes(
        landed.read_quotes_json(spark, landing, per_line=True), root, F.col("trading_day"), T.quotes(spark, sf).select("symbol").distinct(),
        STAMP, name,
    )
    totals = _stock_totals(spark.table(name))
    return _and_drop(spark, totals, name)


def _and_drop(spark, result, name):
    """The result, stored, once its catalog entry is gone again."""
    path = scratch_path(spark, "result")
    result.write.parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


@query
def load_macro_run(spark, sf):
    """Landed macro documents through the load into the catalog, read back by SQL."""
    landing, root = scratch_path(spark, "macro_landing"), scratch_path(spark, "macro")
    D.macro_documents(spark, sf).write.text(landing)
    name = f"macro_{root[-32:]}"
    loads.load_macro(spark, landing, root, STAMP, per_line=True, name=name)
    columns = "series_id, description, units, date, CAST(year AS BIGINT) AS year, month, value, extracted_at"
    read = spark.sql(f"SELECT {columns} FROM {name}").withColumn("value", stable_round("value", 6))
    return _and_drop(spark, read, name)


@query
def load_fundamentals_run(spark, sf):
    """Landed company documents through the load into the catalog, read back by SQL. Later files win within a year."""
    landing, root = scratch_path(spark, "filings"), scratch_path(spark, "fundamentals")
    D.filing_documents(spark, sf).select("value", F.col("doc_pos").alias("landed_order")).write.json(landing)
    name = f"fundamentals_{root[-32:]}"
    docs = spark.read.schema("value string, landed_order long").json(landing)
    loads.load_fundamentals_documents(
        docs, root, STAMP, name=name, capex_tag=T.CAPEX_TAG, revenue_tags=T.REVENUE_TAGS, min_year=T.MIN_YEAR,
        document_order=["landed_order"],
    )
    columns = "cik, symbol, CAST(year AS BIGINT) AS year, capex_usd, revenue_usd, revenue_tag, period_end, filed, extracted_at"
    return _and_drop(spark, spark.sql(f"SELECT {columns} FROM {name}"), name)


@query
def backfill_run(spark, sf):
    """Landed monthly price documents through the backfill into the catalog, read back by SQL."""
    landing, root = scratch_path(spark, "monthly"), scratch_path(spark, "prices")
    D.monthly_documents(spark, sf).write.partitionBy("symbol").text(landing)
    name = f"prices_{root[-32:]}"
    symbol = F.url_decode(F.url_decode(F.regexp_extract("path", "symbol=([^/]*)/", 1)))  # a folder name inside a URL
    loads.backfill_prices(
        spark, landing, root, symbol, "2000-12-31", T.security(spark, sf), "1996-01-01", STAMP, per_line=True, name=name
    )
    read = spark.sql(f"SELECT symbol, date, close, volume, extracted_at FROM {name}").withColumn("close", stable_round("close", 6))
    return _and_drop(spark, read, name)


@query
def dq_quote_errors_stored(spark, sf):
    """All errors of a load that its checks stopped."""
    root = scratch_path(spark, "stopped")
    bad = _bad_quotes(spark, sf)
    try:
        quality.assert_quotes(bad, f"{root}-errors", ["quote_id"])
    except quality.DataQualityError:
        return spark.read.parquet(f"{root}-errors")
    raise AssertionError("the checks should have stopped this load")


@query
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.export_csv(_metrics(spark, sf, True), path, S.EXPORTS["backtest_results"])
    return stored.read_csv(spark, path, StructType([S.RESULTS[c] for c in S.EXPORTS["backtest_results"]]))


@query
def results_roundtrip(spark, sf):
    path = scratch_path(spark, "results")
    points = compare.nest_points(_rolling(spark, sf))
    sinks.export_json(points.withColumn("rolling_sharpe", _text_dates("rolling_sharpe")), path)
    results = stored.read_results(spark, path)
    return compare.flatten_points(results.select("symbol", "rolling_sharpe"))


@query
def catalog_partitions(spark, sf):
    root = scratch_path(spark, "catalog")
    sinks.write_table(_macro_table(spark, sf), root, S.MACRO)
    name = sinks.create_table(spark, S.MACRO, root, f"macro_{root[-32:]}")
    first = stored.partitions(spark, root, S.MACRO.keys).orderBy(*S.MACRO.keys).first()
    sinks.register_partition(spark, name, first.asDict(), f"{root}/series={first.series}/year={first.year}")
    sinks.register_all(spark, name)
    return _and_drop(spark, spark.table(name).groupBy("series", "year").agg(F.count("*").alias("n")), name)


@query
def catalog_tables(spark, sf):
    """All seven tables published, registered by the partitions written, and read back through the catalog."""
    month = F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd")
    crypto = T.load(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("symbol"), F.col("o_totalprice").alias("price"), iso_date("o_orderdate").alias("timestamp"), month.alias("date")
    )
    city = T.load(spark, sf, "customer").select(
        F.col("c_name").alias("city"), F.col("c_acctbal").alias("temperature"), (F.col("c_acctbal") - 1).alias("feels_like"),
        (F.col("c_custkey") % 100).cast("int").alias("humidity"), F.col("c_mktsegment").alias("description"),
        (F.col("c_custkey") % 30).cast("double").alias("wind_speed"), F.lit(STAMP).alias("timestamp"), F.concat(F.lit("n"), "c_nationkey").alias("date"),
    )
    prices = T.prices(spark, sf).select("symbol", iso_date("date").alias("date"), "close", "volume", F.lit(STAMP).alias("extracted_at"))
    facts = fundamentals(annual_only(T.filings(spark, sf)), T.CAPEX_TAG, T.REVENUE_TAGS, T.MIN_YEAR, STAMP)
    frames = [
        (S.STOCKS, T.quotes(spark, sf).withColumn("date", F.col("trading_day"))), (S.MACRO, _macro_table(spark, sf)),
        (S.FUNDAMENTALS_BY_YEAR, facts), (S.PRICES, prices), (S.CRYPTO, crypto), (S.WEATHER, city),
        (S.FORECAST, city.withColumn("forecast_time", F.lit(STAMP))),
    ]
    reports = []
    for table, rows in frames:
        root = scratch_path(spark, table.name)
        name = sinks.create_table(spark, table, root, f"{table.name}_{root[-32:]}")
        snapshots.register_changed(spark, name, table, root, snapshots.publish(rows, root, table))
        keys = ", ".join(table.keys)
        counted = spark.sql(f"SELECT '{table.name}' AS name, count(*) AS records, count(DISTINCT {keys}) AS stored FROM {name}")
        described = counted.withColumn("columns", F.lit(", ".join(spark.table(name).columns)))
        reports.append(_and_drop(spark, described, name))
    return reduce(DataFrame.unionByName, reports)


@query
def exports_roundtrip(spark, sf):
    """All report tables as CSV files with their headings, read back."""
    out, security, spend = scratch_path(spark, "exports"), T.security(spark, sf), T.known_spend(spark, sf)
    results = backtest.run_backtest(T.prices(spark, sf), security, spend, _rate(spark, sf), out)
    written = backtest.export_analyses(results, security, spend, out)
    reports = []
    for name in written:
        read = spark.read.option("header", True).option("escape", '"').csv(f"{out}/{S.EXPORT_FILES.get(name, name)}")
        headings = F.lit(", ".join(read.columns)).alias("headings")
        reports.append(read.agg(F.count("*").alias("records")).select(F.lit(name).alias("name"), headings, "records"))
    return reduce(DataFrame.unionByName, reports)


@query
def load_rejects(spark, sf):
    """Macro documents of which some are cut short, empty or of another form: why each was set aside, and what was loaded."""
    landing, root = scratch_path(spark, "broken"), scratch_path(spark, "macro")
    year = F.regexp_extract("value", '"date":"([0-9]{4})', 1).cast("int")
    broken = (
        F.when(F.col("value").contains('"UNRATE"') & (year % 2 == 0), F.substring("value", 1, 40))
        .when(F.col("value").contains('"GS10"') & (year % 3 == 0), F.lit(""))
        .when(F.col("value").contains('"CPIAUCSL"') & (year % 3 == 1), F.lit('{"CPIAUCSL": 5}'))
        .otherwise(F.col("value"))
    )
    D.macro_documents(spark, sf).select(broken.alias("value")).write.text(landing)
    load = loads.load_macro(spark, landing, root, STAMP, per_line=True)
    loaded = stored.read_table(spark, S.MACRO, root).groupBy(F.concat(F.lit("loaded "), "series_id").alias("state")).agg(F.count("*").alias("n"))
    return loaded.unionByName(load.rejected.groupBy(F.col("reason").alias("state")).agg(F.count("*").alias("n")))


@query
def scan_absent(spark, sf):
    """A scan of which no series is stored raises; the series it asked for, with what it said."""
    root = scratch_path(spark, "scan_absent")
    sinks.write_table(_macro_table(spark, sf), root, S.MACRO)
    wanted = spark.createDataFrame([("NOT_THERE",), ("NOR_THIS",)], "series string")
    try:
        stored.scan_series(spark, root, ["NOT_THERE", "NOR_THIS"], (1990, 2030))
    except ValueError as error:
        said = str(error).replace(root, "the table")
        return stored.missing_series(wanted, stored.read_table(spark, S.MACRO, root), "series").withColumn("message", F.lit(said))
    raise AssertionError("the scan should have raised")


@query
def file_inventory(spark, sf):
    root = scratch_path(spark, "inventory")
    sinks.write_table(_macro_table(spark, sf), root, S.MACRO)
    second = _macro_table(spark, sf).where("month % 2 = 0").withColumn("value", F.col("value") + 1)
    sinks.write_table(second, root, S.MACRO, sinks.APPEND)
    files = stored.file_inventory(spark, root, S.MACRO.keys)
    latest = stored.latest_file(files, S.MACRO.keys)
    rows = stored.with_file(stored.read_table(spark, S.MACRO, root))
    newest = rows.join(latest.select(*S.MACRO.keys, "path"), [*S.MACRO.keys, "path"])
    return newest.groupBy(*S.MACRO.keys).agg(F.count("*").alias("n"), stable_round(F.sum("value"), 4).alias("total"))


# --- returns and risk ---------------------------------------------------------------------------


@query
def period_return(spark, sf):
    return _returns(spark, sf).select("symbol", "date", stable_round("ret", 8).alias("ret"))


@query
def returns_by_month_end(spark, sf):
    return monthly_returns(T.part_prices(spark, sf)).withColumn("ret", stable_round("ret", 8))


@query
def yoy_change(spark, sf):
    wide = period_returns(T.macro(spark, sf), "series_id", "date", "value", lag=12, name="yoy", scale=100)
    return wide.select("series_id", "date", stable_round("yoy", 6).alias("yoy"))


@query
def rolling_mean_min_obs(spark, sf):
    rows = rolling_mean(T.part_prices(spark, sf), "symbol", "date", "close", 12, 6)
    return rows.select("symbol", "date", stable_round("rolling_mean", 6).alias("rolling_mean"))


@query
def drawdown(spark, sf):
    return max_drawdown(T.part_prices(spark, sf)).withColumn("max_drawdown", stable_round("max_drawdown", 8))


@query
def risk_metrics(spark, sf):
    return _metrics(spark, sf, with_spend=True)


def _rolling(spark, sf):
    return risk.rolling_sharpe(_returns(spark, sf), _rate(spark, sf))


@query
def rolling_sharpe(spark, sf):
    return _rolling(spark, sf)


@query
def rolling_sharpe_parts(spark, sf):
    return risk.rolling_sharpe(period_returns(T.part_prices(spark, sf)))


@query
def trailing_sharpe_nulls(spark, sf):
    out = risk.trailing_sharpe(monthly_returns(T.prices(spark, sf)), 0.045)
    return out.select("symbol", "month", stable_round("trailing_sharpe", 6).alias("trailing_sharpe"))


@query
def trailing_sharpe_asof(spark, sf):
    returns = monthly_returns(T.part_prices(spark, sf))
    monthly = cut_lineage(regimes.first_per_month(_regimes(spark, sf)))
    return risk.trailing_sharpe_asof(returns, monthly).withColumn("sharpe", stable_round("sharpe", 6))


@query
def beta(spark, sf):
    sales = cut_lineage(T.sales_by_month(spark, sf))  # both sides come from one pass over the line items
    stock, market = monthly_returns(T.brand_prices(sales)), monthly_returns(T.market_prices(sales))
    return risk.beta(stock, market).withColumn("beta", stable_round("beta", 6))


@query
def risk_free_rate(spark, sf):
    return _rate(spark, sf).select(stable_round("rf", 8).alias("rf"))


# --- comparisons --------------------------------------------------------------------------------


@query
def category_stats(spark, sf):
    return compare.category_stats(_metrics(spark, sf))


@query
def value_chain_summary(spark, sf):
    return compare.value_chain_summary(_metrics(spark, sf), T.security(spark, sf), listing=True)  # brands


def _premium(spark, sf):
    sides = compare.group_premium(_metrics(spark, sf))
    return sides.select(*[c if c == "premium_pct" else stable_round(c, 6).alias(c) for c in sides.columns])


@query
def group_premium(spark, sf):
    return _premium(spark, sf)


@query
def comparison_table(spark, sf):
    return compare.comparison_table(_premium(spark, sf))


@query
def premium_text(spark, sf):
    return compare.premium_text(_premium(spark, sf))


@query
def chain_members(spark, sf):
    return compare.chain_members(_metrics(spark, sf), T.security(spark, sf))


@query
def spend_efficiency(spark, sf):
    return compare.spend_efficiency(_metrics(spark, sf), T.spend(spark, sf)).drop("efficiency")


@query
def efficiency_gap(spark, sf):
    return compare.efficiency_gap(compare.spend_efficiency(_metrics(spark, sf), T.spend(spark, sf)))


@query
def spearman(spark, sf):
    rows = compare.spend_efficiency(_metrics(spark, sf), T.spend(spark, sf))
    return compare.spearman(rows, "ai_pct", "sharpe").withColumn("rho", stable_round("rho", 6))


@query
def spearman_by_segment(spark, sf):
    """Balance against order count of every customer, within each market segment; order counts tie heavily."""
    orders = T.load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    customers = T.load(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    both = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"))
    rho = compare.spearman(both, "c_acctbal", "n_orders", by=["c_mktsegment"], key="c_custkey")
    return rho.withColumn("rho", stable_round("rho", 8))


@query
def ranked_listing(spark, sf):
    return compare.ranked_listing(_metrics(spark, sf), "sharpe_ratio")


@query
def listing_text(spark, sf):
    rows = compare.spend_efficiency(_metrics(spark, sf), T.spend(spark, sf))
    return compare.listing_text(compare.ranked_listing(rows, "ai_pct"))


@query
def export_master(spark, sf):
    return compare.export_master(_metrics(spark, sf, True)).select(*S.EXPORTS["export_master"])


def _text_dates(points):
    return F.transform(
        points,
        lambda p: F.struct(iso_date(p["date"]).alias("date"), p["rolling_sharpe_12m"].alias("rolling_sharpe_12m")),
    )


@query
def nest_flatten(spark, sf):
    return compare.flatten_points(compare.nest_points(_rolling(spark, sf)))


# --- macro regimes ------------------------------------------------------------------------------


@query
def macro_pivot(spark, sf):
    wide = regimes.pivot_series(T.macro(spark, sf), T.THRESHOLDS.series, ["date"])
    return wide.select("date", *[stable_round(c, 6).alias(c) for c in T.THRESHOLDS.series])


@query
def macro_pivot_reloads(spark, sf):
    """The same dates loaded three times, each time with smaller values: the last load stands."""
    times = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(f"2024-0{n}-01").alias("at")) for n in (3, 1, 2)]))
    loads_ = T.macro(spark, sf).select("*", times.alias("load"))
    falling = loads_.withColumns({"value": F.col("value") * (1 - F.col("load.n") / 10), "extracted_at": F.col("load.at")})
    wide = regimes.pivot_series(falling, T.THRESHOLDS.series, ["extracted_at"])
    return wide.select("date", *[stable_round(c, 6).alias(c) for c in T.THRESHOLDS.series])


@query
def regime_labels(spark, sf):
    return _regimes(spark, sf).withColumn("fedfunds", stable_round("fedfunds", 6))


def _round_panel(panel):
    numeric = [f.name for f in panel.schema if f.dataType.simpleString() == "double"]
    return panel.withColumns({c: stable_round(c, 6) for c in numeric})


@query
def monthly_panel(spark, sf):
    return _round_panel(_panel(spark, sf, wide=True))


@query
def premium_by_regime(spark, sf):
    return _summary(spark, sf)


@query
def overall_premium(spark, sf):
    return _round_panel(regimes.overall_premium(_panel(spark, sf)))


@query
def regime_crosstab(spark, sf):
    return _round_panel(regimes.regime_crosstab(_summary(spark, sf)))


@query
def regime_runs(spark, sf):
    return regimes.regime_runs(_panel(spark, sf))


@query
def regime_stance(spark, sf):
    return regimes.stance(_summary(spark, sf), cuts=(0.05, 0.01, -0.01))


@query
def regime_parts(spark, sf):
    return regimes.split_regime(_summary(spark, sf))


# --- whole plans --------------------------------------------------------------------------------


@query
def backtest_run(spark, sf):
    """Prices to stored result records to the master export, read back from CSV."""
    out, security, spend = scratch_path(spark, "backtest"), T.security(spark, sf), T.known_spend(spark, sf)
    results = backtest.run_backtest(T.prices(spark, sf), security, spend, _rate(spark, sf), out)
    backtest.export_analyses(results, security, spend, out)
    columns = S.EXPORTS["export_master"]
    schema = StructType([S.RESULTS[c] for c in columns[:-2]]).add("build_or_rent", StringType()).add("value_chain_rank", IntegerType())
    return stored.read_csv(spark, f"{out}/powerbi_master", schema)


@query
def regime_run(spark, sf):
    """Macro series and prices to the stored panel and its stored summary."""
    out = scratch_path(spark, "regimes")
    _, summary = regime.run_regimes(T.macro(spark, sf), T.prices(spark, sf), out, GROUPS, T.THRESHOLDS, ["date"])
    return summary


# --- quality and freshness ----------------------------------------------------------------------


def _bad_quotes(spark, sf):
    return T.quotes(spark, sf).withColumns(
        {
            "price": F.when(F.col("price") >= 0.1, F.col("price")),
            "volume": F.col("volume") - 5000,
        }
    )


@query
def dq_quotes(spark, sf):
    return quality.check_quotes(_bad_quotes(spark, sf), keep=["quote_id"])


@query
def dq_macro(spark, sf):
    rows = T.macro(spark, sf).withColumn("date", F.when(F.col("month") != 3, F.col("date")))
    return quality.check_macro(rows, quality.macro_ranges(spark))


@query
def dq_fundamentals(spark, sf):
    rows = fundamentals(annual_only(T.filings(spark, sf)), T.CAPEX_TAG, T.REVENUE_TAGS, T.MIN_YEAR)
    return quality.check_fundamentals(rows.withColumnsRenamed({"capex_usd": "capex", "revenue_usd": "revenue"}))


@query
def dq_missing_columns(spark, sf):
    """The reports of checks whose frame lacks a required column."""
    macro = quality.check_macro(T.macro(spark, sf).drop("date"), quality.macro_ranges(spark)).withColumn("table", F.lit("macro"))
    facts = fundamentals(annual_only(T.filings(spark, sf)), T.CAPEX_TAG, T.REVENUE_TAGS, T.MIN_YEAR)
    filed = quality.check_fundamentals(facts.withColumnsRenamed({"capex_usd": "capex"})).withColumn("table", F.lit("fundamentals"))
    quotes = quality.check_quotes(T.quotes(spark, sf).drop("price"), keep=["quote_id"])
    lacking = quotes.where("error LIKE '%price%'").groupBy(F.regexp_replace("error", "^[^:]*: ", "").alias("errors")).agg(F.count("*").alias("row_count"))
    columns = ["table", "row_count", "errors", "valid"]
    named = lacking.select(F.lit("quotes").alias("table"), "row_count", "errors", F.lit(False).alias("valid"))
    return macro.select(*columns).unionByName(filed.select(*columns)).unionByName(named)


@query
def missing_series(spark, sf):
    """Brands of the catalogue without spending data."""
    return stored.missing_series(T.security(spark, sf), T.known_spend(spark, sf), "symbol")


@query
def dimension_join(spark, sf):
    """Parts dealt to the listed securities: the constant dimension meets a given table."""
    symbols = F.array(*[F.lit(s) for s, *_ in C.SECURITIES])
    parts = T.load(spark, sf, "part").select(
        F.get(symbols, (F.col("p_partkey") % len(C.SECURITIES)).cast("int")).alias("symbol"), "p_size"
    )
    totals = parts.groupBy("symbol").agg(F.count("*").alias("parts"), F.sum("p_size").alias("size"))
    return S.dims(spark).security.join(totals, "symbol").drop("pos")


@query
def record_counts(spark, sf):
    return quality.record_counts(T.quotes(spark, sf), ["kind", "trading_day"])


@query
def load_report(spark, sf):
    return quality.load_report(T.security(spark, sf), T.known_spend(spark, sf))


def _quote_files(spark, sf):
    newest = first_per_key(T.quotes(spark, sf), ["symbol", "trading_day"], [F.col("ts").desc(), F.col("quote_id").desc()])
    return newest.select(
        F.to_date("ts").alias("day"),
        F.concat(F.lit("part-"), F.floor(F.hour("ts") / 3).cast("string")).alias("path"),
        F.col("ts").alias("modified"),
        "symbol",
        "price",
    )


def _completeness(spark, sf):
    files = cut_lineage(_quote_files(spark, sf))  # the newest quote per symbol and day
    days = files.select("day").distinct()
    later = days.select(F.date_add("day", 5).alias("day"))
    return freshness.completeness(files, days.union(later).distinct(), 18)


@query
def completeness(spark, sf):
    state = _completeness(spark, sf)
    total = F.aggregate(F.map_values("prices"), F.lit(0.0), lambda a, x: a + x)
    return state.select(
        "day", "status", "message", "records",
        F.size(F.map_keys("prices")).cast("bigint").alias("n_prices"), stable_round(total, 4).alias("price_sum"),
    )


def _staleness(spark, sf):
    def feed(table, column):
        stamp = F.col(column)
        return T.load(spark, sf, table).select(
            F.lit(table).alias("feed"), iso_date(stamp).alias("path"), stamp.cast("timestamp").alias("modified")
        )

    files = feed("events", "ts").unionByName(feed("orders", "o_orderdate")).unionByName(feed("lineitem", "l_shipdate"))
    limits = spark.createDataFrame(
        [("events", 35), ("orders", 120), ("lineitem", 120), ("filings", 120)], "feed string, max_days int"
    )
    return freshness.staleness(files, AS_OF, limits)


@query
def staleness(spark, sf):
    return _staleness(spark, sf)


@query
def completeness_stored(spark, sf):
    """The state of each stored day from its newest file: every day is stored whole, and once more with the first quote per symbol."""
    root = scratch_path(spark, "stored_quotes")
    rows = T.quotes(spark, sf).withColumn("date", F.col("trading_day"))
    sinks.write_table(rows, root, S.STOCKS)
    first = first_per_key(rows, ["symbol", "trading_day"], [F.col("quote_id").asc()])
    sinks.write_table(first, root, S.STOCKS, sinks.APPEND)
    files = freshness.stored_quotes(stored.read_table(spark, S.STOCKS, root))
    days = stored.partitions(spark, root, S.STOCKS.keys).select(F.to_date("date").alias("day"))
    state = freshness.completeness(files, days.unionByName(days.select(F.date_add("day", 40).alias("day"))), 18)
    return state.select("day", "status", "message", "records", F.size(F.map_keys("prices")).cast("bigint").alias("n_prices"))


@query
def staleness_stored(spark, sf):
    """Stored feeds as seen 40 days after they were written."""
    macro, prices = scratch_path(spark, "macro_indicators"), scratch_path(spark, "historical_prices")
    sinks.write_table(_macro_table(spark, sf), macro, S.MACRO)
    quoted = T.prices(spark, sf).select("symbol", iso_date("date").alias("date"), "close", "volume", F.lit(STAMP).alias("extracted_at"))
    sinks.write_table(quoted, prices, S.PRICES)
    files = freshness.stored_feeds(
        spark, {"macro_indicators": macro, "historical_prices": prices, "fundamentals": scratch_path(spark, "never_written")}
    )
    limits = spark.createDataFrame([("macro_indicators", 35), ("historical_prices", 120), ("fundamentals", 120)], "feed string, max_days int")
    later = datetime.now(timezone.utc) + timedelta(days=40, hours=12)
    return freshness.staleness(files, later.strftime("%Y-%m-%d %H:%M:%S"), limits)


@query
def health(spark, sf):
    """The roll-up of every day: the day's quotes beside the state of all feeds."""
    days = _completeness(spark, sf)
    feeds = _staleness(spark, sf).agg(F.collect_list(F.struct("feed", "status", "message"))).scalar()  # four feeds
    return freshness.health([days.withColumn("feed", F.lit("quotes")), days.select("day", F.inline(feeds))], ["day"])


# --- SQL catalogue ------------------------------------------------------------------------------


def _catalogue(name, **options):
    def run(spark, sf):
        T.register_views(spark, sf)
        return sqlcatalog.run(spark, name, **options)

    return run


QUERIES["sql1_daily_leader"] = _catalogue("daily_leader", tiebreak=("symbol", "quote_id"))
QUERIES["sql2_asset_summary"] = _catalogue("asset_summary")
QUERIES["sql3_change_spread"] = _catalogue("change_spread")
QUERIES["sql4_moving_average"] = _catalogue("moving_average", tiebreak=("timestamp", "quote_id"), keep=("quote_id",))
QUERIES["sql5_high_volume"] = _catalogue("high_volume", keep=("quote_id",))
QUERIES["sql6_price_range"] = _catalogue("price_range")


def _sql7(spark, sf):
    T.register_views(spark, sf)
    return sqlcatalog.run(spark, "category_performance", tiebreak=("quote_id",), groups=T.quote_groups(spark, sf))


QUERIES["sql7_category_performance"] = _sql7
QUERIES["sql8_dollar_volume"] = _catalogue("dollar_volume", tiebreak=("quote_id",), keep=("quote_id",))
