"""Landed documents built from the tables, so that parsing work grows with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.workload import tables as T

MISSING = "."


def quote_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(quote_id, symbol, value)``: one document per event, some with fields left out, some empty."""
    q = T.quotes(spark, sf_dir)
    filled = F.col("price") >= 0.5

    def text(column: str):
        return F.when(filled, F.col(column).cast("string"))

    quote = F.struct(
        text("symbol").alias("01. symbol"),
        text("price").alias("05. price"),
        text("volume").alias("06. volume"),
        text("trading_day").alias("07. latest trading day"),
        F.when(F.col("volume") % 10 > 0, text("previous_close")).alias("08. previous close"),
        text("change").alias("09. change"),
    )
    return q.select("quote_id", "symbol", F.to_json(F.struct(quote.alias("Global Quote"))).alias("value"))


def macro_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per series and year with at most twelve observations; some values are marked missing."""
    m = T.macro(spark, sf_dir)
    shown = F.when((F.col("series_id") == "UNRATE") & (F.col("value") < 5.0), MISSING).otherwise(F.col("value").cast("string"))
    observation = F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), shown.alias("value"))
    years = m.groupBy("series_id", "description", "units", "year").agg(
        F.array_sort(F.collect_list(observation)).alias("observations")
    )
    body = F.struct("series_id", "description", "units", "observations")
    return years.select(F.to_json(F.create_map("series_id", body)).alias("value"))


def filing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per filing: a company's filings need no gathering, however many it has."""
    f = T.filings(spark, sf_dir)
    filing = F.struct("fp", "form", "fy", "val", "end", "filed")
    units = F.struct(F.create_map(F.lit("USD"), F.array(filing)).alias("units"))
    company = F.struct(
        "cik",
        F.col("symbol").alias("entity_name"),
        F.create_map(F.lit("us-gaap"), F.create_map("tag", units)).alias("facts"),
    )
    return f.select(F.col("pos").alias("doc_pos"), F.to_json(F.create_map("symbol", company)).alias("value"))


def monthly_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(symbol, value)``: one document per symbol and year with at most twelve months."""
    p = T.prices(spark, sf_dir)
    fields = F.struct(
        F.col("close").cast("string").alias("5. adjusted close"), F.col("volume").cast("string").alias("6. volume")
    )
    entry = F.struct(F.date_format("date", "yyyy-MM-dd").alias("d"), fields.alias("f"))
    years = p.groupBy("symbol", F.year("date")).agg(F.map_from_entries(F.collect_list(entry)).alias("months"))
    return years.select(
        "symbol", F.to_json(F.struct(F.col("months").alias("Monthly Adjusted Time Series"))).alias("value")
    )
