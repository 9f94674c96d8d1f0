"""Feed loads: landed documents through cleaning and checks into the partitioned tables and, if named, into the catalog.

Each load stores its normalised records once below the scratch area; checks, table and report read them from there.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe import constants as C
from marketframe import schemas as S
from marketframe.functions import Stamp
from marketframe.operators.fundamentals import annual_only, fundamentals
from marketframe.operators.quality import (
    assert_nonempty,
    assert_quotes,
    check_fundamentals,
    check_macro,
    load_report,
    macro_ranges,
)
from marketframe.session import scratch_path
from marketframe.sinks.snapshots import publish, register_changed
from marketframe.sinks.tables import OVERWRITE, SKIP, create_table
from marketframe.sources import landed


@dataclass(frozen=True)
class Load:
    """The records of a load, its report (not blocking unless stated), and the documents it set aside, if any."""

    records: DataFrame
    report: DataFrame
    rejected: DataFrame | None = None


def _once(records: DataFrame, label: str) -> DataFrame:
    """The records, parsed and stored once."""
    path = scratch_path(records.sparkSession, label)
    records.write.parquet(path)
    return records.sparkSession.read.parquet(path)


def _publish(records: DataFrame, root: str, table: S.Table, mode: str, name: str | None) -> None:
    """Publish one version of the table and, under ``name``, register the partitions it changed."""
    changed = publish(records, root, table, mode)
    if name:
        spark = records.sparkSession
        create_table(spark, table, root, name)
        register_changed(spark, name, table, root, changed)


def _set_aside(docs: DataFrame, feed: str, root: str) -> DataFrame | None:
    """Add the documents that give no record, with the reason, to ``<root>-rejected``, and return those of this load.

    This reads the documents once more; only those set aside are written.
    """
    path = f"{root}-rejected/load={uuid.uuid4().hex}"
    landed.rejected(docs, feed).write.parquet(path)
    found = docs.sparkSession.read.parquet(path)
    return None if found.isEmpty() else found


def load_quotes(
    raw: DataFrame, root: str, day: str | Column, expected: DataFrame, stamp: Stamp = None, name: str | None = None
) -> Load:
    """Text quotes of one day, or of the days in a column, into ``stocks``. Stored days are left alone.

    A failed check stops the load and leaves all errors below ``<root>-errors``. The report lists every expected symbol as
    loaded or failed.
    """
    quotes = assert_quotes(_once(landed.normalise_quotes(raw, stamp), "load_quotes"), f"{root}-errors")
    date = day if isinstance(day, Column) else F.lit(day)
    _publish(quotes.withColumn("date", date), root, S.STOCKS, SKIP, name)
    return Load(quotes, load_report(expected, quotes))


def load_macro(
    spark: SparkSession, path: str, root: str, stamp: Stamp = None, mode: str = OVERWRITE, per_line: bool = False,
    name: str | None = None,
) -> Load:
    """Macro documents into ``macro_indicators``, one partition per series and year. Documents that give nothing are set aside."""
    docs = landed.read_documents(spark, path, per_line)
    rejected, parsed = _set_aside(docs, "macro", root), landed.parse_macro(docs)
    records = _once(landed.macro_records(parsed, stamp), "load_macro")
    assert_nonempty(records, "No macro records extracted: all values missing")
    _publish(records.withColumn("series", F.col("series_id")), root, S.MACRO, mode, name)
    return Load(records, check_macro(records, macro_ranges(spark)), rejected)


def load_fundamentals(
    spark: SparkSession, path: str, root: str, stamp: Stamp = None, mode: str = OVERWRITE, per_line: bool = False,
    name: str | None = None, table: S.Table = S.FUNDAMENTALS_BY_YEAR,
) -> Load:
    """Company facts into ``fundamentals``; files ascend by path.

    A load replaces company-years. The default layout has one partition per year with companies in order, so it holds any number of them;
    ``FUNDAMENTALS`` has one per company and year, for a handful of companies.
    """
    docs = landed.read_documents(spark, path, per_line)
    return load_fundamentals_documents(docs, root, stamp, mode, name, document_order=["path"], table=table)


def load_fundamentals_documents(
    docs: DataFrame, root: str, stamp: Stamp = None, mode: str = OVERWRITE, name: str | None = None,
    capex_tag: str = C.CAPEX_TAG, revenue_tags: Sequence[str] = C.REVENUE_TAGS, min_year: int = C.MIN_FISCAL_YEAR,
    document_order: Sequence[str] = (), table: S.Table = S.FUNDAMENTALS_BY_YEAR,
) -> Load:
    """The same for documents at hand, with the columns that order a company's documents."""
    rejected = _set_aside(docs, "company_facts", root)
    facts = annual_only(landed.parse_xbrl(docs, [capex_tag, *revenue_tags]))
    records = _once(fundamentals(facts, capex_tag, revenue_tags, min_year, stamp, document_order), "load_fundamentals")
    assert_nonempty(records, "No fundamental records extracted")
    _publish(records, root, table, mode, name)
    checked = records.withColumnsRenamed({"capex_usd": "capex", "revenue_usd": "revenue"})
    return Load(records, check_fundamentals(checked), rejected)


def backfill_prices(
    spark: SparkSession,
    path: str,
    root: str,
    symbol: Column,
    end: str,
    expected: DataFrame,
    start: str = C.PRICE_START,
    stamp: Stamp = None,
    per_line: bool = False,
    name: str | None = None,
) -> Load:
    """Monthly price documents into ``historical_prices``; a symbol's partition is replaced.

    ``symbol`` says how to read the symbol from a document's ``path``.
    """
    docs = landed.read_documents(spark, path, per_line).withColumn("symbol", symbol)
    rejected = _set_aside(docs, "monthly_prices", root)
    records = _once(landed.parse_monthly(docs, start, end, stamp), "backfill")
    _publish(records, root, S.PRICES, OVERWRITE, name)
    return Load(records, load_report(expected, records), rejected)
