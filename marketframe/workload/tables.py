"""The canonical tables derived from the order / event tables the checks run on."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketframe.functions import case_label, change_percent, stable_round
from marketframe.operators.regimes import Thresholds

# Category per brand number modulo five, regime cut points of this data.
CATEGORIES = ["Infrastructure", "AI Builder", "AI Integrator", "Control", "Legacy Tech"]
THRESHOLDS = Thresholds(inflation_pct=0.5, unemployment_pct=5.0)
STREAM_TYPES = {"Infrastructure": "CLICK", "AI Builder": "VIEW", "AI Integrator": "ERROR", "Legacy Tech": "PURCHASE"}


@lru_cache(maxsize=256)
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The scan of one table. Its schema is looked up once per session, its files each time."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def _brand_number(column: str = "p_brand"):
    return F.regexp_extract(column, "([0-9]+)", 1).cast("int")


def sales_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(symbol, date, amount, quantity)``: monthly brand totals."""
    lines = load(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_quantity", "l_extendedprice")
    brands = load(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("symbol"))
    return (
        lines.join(brands, lines.l_partkey == brands.p_partkey)
        .groupBy("symbol", F.last_day(F.to_date("l_shipdate")).alias("date"))
        .agg(F.sum("l_extendedprice").alias("amount"), F.sum("l_quantity").alias("quantity"))
    )


def brand_prices(sales: DataFrame) -> DataFrame:
    """``(symbol, date, close, volume)``: one row per brand and month."""
    return sales.select(
        "symbol", "date", (F.col("amount") / F.col("quantity")).alias("close"),
        F.col("quantity").cast("bigint").alias("volume"),
    )


def market_prices(sales: DataFrame) -> DataFrame:
    """``(symbol, date, close)`` of everything together."""
    close = (F.sum("amount") / F.sum("quantity")).alias("close")
    return sales.groupBy("date").agg(close).withColumn("symbol", F.lit("MARKET"))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brand_prices(sales_by_month(spark, sf_dir))


def part_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per part: very many symbols with missing months."""
    monthly = (
        load(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", F.last_day(F.to_date("l_shipdate")).alias("date"))
        .agg((F.sum("l_extendedprice") / F.sum("l_quantity")).alias("close"))
    )
    return monthly.select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"), "date", "close")


def security(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = _brand_number("symbol")
    brands = load(spark, sf_dir, "part").select(F.col("p_brand").alias("symbol")).distinct()
    label = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), number % 5 + 1)
    return brands.select(
        "symbol", label.alias("category"), F.concat(F.lit("strategy "), number.cast("string")).alias("ai_strategy"),
        number.alias("pos"),
    )


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spending of every brand."""
    parts = load(spark, sf_dir, "part")
    retail = F.sum("p_retailprice")
    return parts.groupBy(F.col("p_brand").alias("symbol")).agg(
        stable_round(retail / 1e4, 1).alias("capex_2025_B"),
        stable_round(retail * 1.5 / 1e4, 1).alias("capex_2026_B"),
        (F.sum("p_size") % 90 + 10).cast("int").alias("ai_pct"),
        stable_round(retail * 4 / 1e4, 1).alias("revenue_2025_B"),
    )


def known_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spending as an incomplete dimension: brands whose parts have an even total size are not in it."""
    sized = load(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("symbol")).agg(F.sum("p_size").alias("size"))
    return spend(spark, sf_dir).join(sized.where("size % 2 = 1"), "symbol", "left_semi")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows as quotes; several per symbol and day, prices from the event values."""
    k = F.from_json("props", "k int")["k"]
    events = load(spark, sf_dir, "events").withColumn("k", k)
    previous = F.col("value") * 0.5 + F.col("k") / 10
    return (
        events.select(
            F.col("event_id").alias("quote_id"),
            F.concat(F.upper("event_type"), F.lit("-"), (F.col("user_id") % 4).cast("string")).alias("symbol"),
            F.upper("event_type").alias("kind"),
            F.col("value").alias("price"),
            previous.alias("previous_close"),
            (F.col("value") - previous).alias("change"),
            (F.col("user_id") * 1000 + F.col("k")).alias("volume"),
            F.date_format("ts", "yyyy-MM-dd").alias("trading_day"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            "ts",
        )
        .withColumn("change_percent", change_percent("change", "previous_close"))
    )


def quote_groups(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    return {name: [f"{kind}-{i}" for i in range(4)] for name, kind in STREAM_TYPES.items()}


def crypto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("symbol"), F.col("o_totalprice").alias("price")
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(F.col("c_name").alias("city"), F.col("c_acctbal").alias("temperature"))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    quotes(spark, sf_dir).createOrReplaceTempView("stocks")
    crypto(spark, sf_dir).createOrReplaceTempView("crypto")
    weather(spark, sf_dir).createOrReplaceTempView("weather")


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(series_id, description, units, date, year, month, value)``: monthly averages under four series ids."""
    orders = (
        load(spark, sf_dir, "orders")
        .groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("date"))
        .agg((F.avg("o_totalprice") / 50000).alias("GS10"))
    )
    lines = (
        load(spark, sf_dir, "lineitem")
        .groupBy(F.trunc(F.to_date("l_shipdate"), "month").alias("date"))
        .agg(
            (F.avg("l_extendedprice") / 200).alias("CPIAUCSL"),
            (F.avg("l_discount") * 100).alias("UNRATE"),
            (F.avg("l_tax") * 100).alias("FEDFUNDS"),
        )
    )
    tall = orders.select(F.lit("GS10").alias("series_id"), "date", F.col("GS10").alias("value")).unionByName(
        lines.unpivot("date", ["CPIAUCSL", "UNRATE", "FEDFUNDS"], "series_id", "value").select("series_id", "date", "value")
    )
    return tall.select(
        "series_id",
        F.concat(F.lit("about "), F.col("series_id")).alias("description"),
        case_label("series_id", {"index_1982": ["CPIAUCSL"]}, "percent").alias("units"),
        "date",
        F.year("date").cast("bigint").alias("year"),
        F.month("date").cast("bigint").alias("month"),
        "value",
    )


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as filings: company = customer, tag = priority, fiscal year = order year."""
    return load(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cik"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"),
        F.col("o_orderpriority").alias("tag"),
        F.col("o_orderkey").alias("pos"),
        F.when(F.col("o_orderstatus") == "F", "Q3").otherwise("FY").alias("fp"),
        F.when(F.col("o_orderstatus") == "P", "10-Q").otherwise("10-K").alias("form"),
        F.year("o_orderdate").alias("fy"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("val"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("end"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), 30), "yyyy-MM-dd").alias("filed"),
    )


# Tag roles when orders stand in for filings.
CAPEX_TAG = "1-URGENT"
REVENUE_TAGS = ["2-HIGH", "3-MEDIUM", "5-LOW"]
MIN_YEAR = 1996
