"""Company fundamentals from annual XBRL facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketframe import constants as C
from marketframe.functions import Stamp, iso_stamp


def annual_only(facts: DataFrame, tags: Sequence[str] | None = None, min_year: int | None = None) -> DataFrame:
    """Full-year values of annual filings, optionally for some tags and from a fiscal year on."""
    out = facts.where((F.col("fp") == "FY") & (F.col("form") == "10-K"))
    if tags is not None:
        out = out.where(F.col("tag").isin(*tags))
    return out if min_year is None else out.where(F.col("fy") >= min_year)


def fundamentals(
    annual: DataFrame,
    capex_tag: str = C.CAPEX_TAG,
    revenue_tags: Sequence[str] = C.REVENUE_TAGS,
    min_year: int = C.MIN_FISCAL_YEAR,
    stamp: Stamp = None,
    document_order: Sequence[str] = (),
) -> DataFrame:
    """One row per annual capex filing from ``min_year`` on, with that company's revenue of the year.

    Revenue comes from the first tag in the list for which the company has any annual filing, whatever
    its year; the last filing wins within a fiscal year, by ``document_order`` (columns that order a company's documents, such
    as the path or the landing time; needed when it has several) and then by the position in the document. Companies without capex give
    no row, companies without revenue give NULL revenue and tag. Repeated capex filings are all kept.

    Revenue is aggregated to (company, tag, year) before anything is ordered, so choosing the tag looks
    at a few rows per company, and a company with very many filings only makes the left side of the one
    equi-join longer, which adaptive execution splits.
    """
    priority = F.array_position(F.array(*[F.lit(t) for t in revenue_tags]), F.col("tag"))
    by_year = (
        annual.where(F.col("tag").isin(*revenue_tags))
        .groupBy("cik", priority.alias("priority"), F.col("tag").alias("revenue_tag"), "fy")
        .agg(F.max_by("val", F.struct(*document_order, "pos", "val")).alias("revenue_usd"))
    )
    chosen = by_year.withColumn("best", F.min("priority").over(W.partitionBy("cik"))).where(
        F.col("priority") == F.col("best")
    )
    # One row per company: the tag and its revenue by fiscal year, as many entries as there are years.
    revenue = chosen.groupBy("cik").agg(
        F.first("revenue_tag").alias("revenue_tag"),
        F.map_from_entries(F.collect_list(F.struct("fy", "revenue_usd"))).alias("by_year"),
    )
    capex = annual.where((F.col("tag") == capex_tag) & (F.col("fy") >= min_year))
    out = capex.join(revenue, "cik", "left").withColumn("revenue_usd", F.try_element_at("by_year", F.col("fy")))
    columns = [
        "cik",
        "symbol",
        F.col("fy").cast("bigint").alias("year"),
        F.col("val").alias("capex_usd"),
        "revenue_usd",
        "revenue_tag",
        F.col("end").alias("period_end"),
        "filed",
    ]
    return out.select(*columns, iso_stamp(stamp).alias("extracted_at"))
