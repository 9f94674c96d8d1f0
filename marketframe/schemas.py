"""Table contracts: canonical tables, landed documents, nested results and dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketframe import constants as C


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType()}


def _struct(columns: str) -> T.StructType:
    """``"name type, name type"`` as a schema, without needing a running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Table:
    """A partitioned Parquet table: column contract plus Hive partition keys.

    ``cluster`` columns order the rows within a partition, so that file statistics serve look-ups by them. ``unit`` columns tell what a load replaces
    where that is less than a partition.
    """

    name: str
    columns: T.StructType
    keys: tuple[str, ...]
    cluster: tuple[str, ...] = ()
    unit: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        """Columns followed by the partition keys, keys always as strings."""
        fields = [f for f in self.columns if f.name not in self.keys]
        return T.StructType(fields + [T.StructField(k, T.StringType()) for k in self.keys])


STOCKS = Table(
    "stocks",
    _struct(
        "symbol string, price double, previous_close double, change double, change_percent double, "
        "volume bigint, trading_day string, timestamp string"
    ),
    ("date",),
)
MACRO = Table(
    "macro_indicators",
    _struct(
        "series_id string, description string, units string, date string, year bigint, month bigint, "
        "value double, extracted_at string"
    ),
    ("series", "year"),
)
FUNDAMENTALS = Table(
    "fundamentals",
    _struct(
        "cik string, symbol string, year bigint, capex_usd bigint, revenue_usd bigint, revenue_tag string, "
        "period_end string, filed string, extracted_at string"
    ),
    ("cik", "year"),
)
# The same content for any number of companies: one folder per year, rows in company order, a load replaces company-years.
FUNDAMENTALS_BY_YEAR = replace(FUNDAMENTALS, keys=("year",), cluster=("cik",), unit=("cik", "year"))
PRICES = Table(
    "historical_prices",
    _struct("symbol string, date string, close double, volume bigint, extracted_at string"),
    ("symbol",),
)
CRYPTO = Table("crypto", _struct("symbol string, price double, timestamp string"), ("date",))
WEATHER = Table(
    "weather",
    _struct(
        "city string, temperature double, feels_like double, humidity int, description string, "
        "wind_speed double, timestamp string"
    ),
    ("date",),
)
FORECAST = Table(
    "forecast",
    _struct(
        "city string, forecast_time string, temperature double, feels_like double, humidity int, "
        "description string, wind_speed double, timestamp string"
    ),
    ("date",),
)
TABLES = {t.name: t for t in (STOCKS, MACRO, FUNDAMENTALS, PRICES, CRYPTO, WEATHER, FORECAST)}

# A landed record of the quote feed; every field is text.
RAW_QUOTES = _struct(
    "symbol string, price string, volume string, trading_day string, previous_close string, "
    "change string, change_percent string"
)

# Landed documents with nested maps, as DDL for ``from_json``.
QUOTE_DOC = "`Global Quote` map<string,string>"
MACRO_DOC = (
    "map<string,struct<series_id:string,description:string,units:string,"
    "observations:array<struct<date:string,value:string>>>>"
)
FILINGS = "array<struct<fp:string,form:string,fy:int,val:bigint,`end`:string,filed:string>>"
XBRL_DOC = f"map<string,struct<cik:string,entity_name:string,facts:map<string,map<string,struct<units:map<string,{FILINGS}>>>>>>"
MONTHLY_DOC = "`Monthly Adjusted Time Series` map<string,struct<`5. adjusted close`:string,`6. volume`:string>>"


def picked_facts(tags: Sequence[str], taxonomy: str, unit: str) -> str:
    """Company facts of which only some tags are read: like ``XBRL_DOC``, with names in place of the maps below ``facts``."""

    def quoted(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    by_tag = ",".join(f"{quoted(t)}:struct<units:struct<{quoted(unit)}:{FILINGS}>>" for t in tags)
    return f"map<string,struct<cik:string,facts:struct<{quoted(taxonomy)}:struct<{by_tag}>>>>"


# Nested per-symbol results.
_METRICS = _struct(
    "symbol string, category string, ai_strategy string, annualized_return double, "
    "annualized_volatility double, sharpe_ratio double, max_drawdown double, months_analyzed bigint, "
    "start_date string, end_date string"
)
_SPENDING = _struct(
    "capex_2025_B double, capex_2026_B double, ai_pct_of_capex int, est_ai_spend_2026_B double"
)
_POINTS = T.ArrayType(_struct("date string, rolling_sharpe_12m double"))
RESULTS = T.StructType([*_METRICS, T.StructField("rolling_sharpe", _POINTS), *_SPENDING])

# Names of exported files that differ from the table's.
EXPORT_FILES = {"export_master": "powerbi_master"}

# Column lists of the CSV exports, or column -> heading where they differ.
EXPORTS: dict[str, list[str] | dict[str, str]] = {
    "backtest_results": [
        "symbol", "category", "ai_strategy", "annualized_return", "annualized_volatility", "sharpe_ratio",
        "max_drawdown", "months_analyzed", "start_date", "end_date", "capex_2025_B", "capex_2026_B",
        "ai_pct_of_capex", "est_ai_spend_2026_B",
    ],
    "export_master": [
        "symbol", "category", "ai_strategy", "annualized_return", "annualized_volatility", "sharpe_ratio",
        "max_drawdown", "capex_2025_B", "capex_2026_B", "ai_pct_of_capex", "est_ai_spend_2026_B",
        "build_or_rent", "value_chain_rank",
    ],
    "category_summary": ["category", "avg_return", "avg_volatility", "avg_sharpe", "stock_count"],
    "build_vs_rent": {
        "metric": "metric", "left_value": "AI Builders", "right_value": "AI Integrators", "premium": "premium",
    },
    "capex_efficiency": [
        "symbol", "category", "sharpe", "total_capex_2026", "ai_pct", "ai_spend_2026",
        "capex_to_revenue_pct", "sharpe_per_B",
    ],
    "value_chain_summary": [
        "rank", "category", "stocks", "avg_return", "avg_volatility", "avg_sharpe", "stock_count",
    ],
    "rolling_sharpe": ["symbol", "category", "date", "rolling_sharpe_12m"],
}


@dataclass(frozen=True)
class Dims:
    """The dimension tables as DataFrames."""

    security: DataFrame
    spend: DataFrame
    entity: DataFrame
    series: DataFrame


def dims(spark: SparkSession) -> Dims:
    """Dimension constants as DataFrames; they are local relations, so the optimizer knows their size."""
    security = [(s, c, a, i) for i, (s, c, a) in enumerate(C.SECURITIES)]
    return Dims(
        security=spark.createDataFrame(security, "symbol string, category string, ai_strategy string, pos int"),
        spend=spark.createDataFrame(
            C.SPEND,
            "symbol string, capex_2025_B double, capex_2026_B double, ai_pct int, revenue_2025_B double",
        ),
        entity=spark.createDataFrame(C.ENTITIES, "symbol string, cik string"),
        series=spark.createDataFrame(C.SERIES, "series_id string, description string, units string"),
    )
