"""Landed JSON documents: read the text, parse it with a fixed schema, reshape it to records."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe import constants as C
from marketframe import schemas as S
from marketframe.functions import Stamp, change_percent, iso_stamp, parse_date


def read_documents(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """``(path, value)`` rows: one document per file, or one per line."""
    text = spark.read.text(path, wholetext=not per_line)
    return text.select(F.col("_metadata.file_path").alias("path"), "value")


def rejected(docs: DataFrame, feed: str, text: str = "value") -> DataFrame:
    """The documents a feed's parser gives nothing for, as ``(other columns..., reason, text)``: what a load has to report instead of passing over.

    ``feed`` is ``quotes``, ``macro``, ``company_facts`` or ``monthly_prices``. A document is empty (null or blank), no JSON, or JSON without a record
    of the feed.
    """

    def any_value(name: str) -> Callable[[Column], Column]:
        return lambda found: F.exists(F.map_values(found), lambda one: one[name].isNotNull())

    forms: dict[str, tuple[str, Callable[[Column], Column]]] = {
        "quotes": (S.QUOTE_DOC, lambda found: F.size(found["Global Quote"]) > 0),
        "macro": (S.MACRO_DOC, any_value("observations")),
        "company_facts": (S.XBRL_DOC, any_value("facts")),
        "monthly_prices": (S.MONTHLY_DOC, lambda found: F.size(found["Monthly Adjusted Time Series"]) > 0),
    }
    form, filled = forms[feed]
    reason = (
        F.when(F.coalesce(F.trim(text), F.lit("")) == "", C.EMPTY_DOCUMENT)
        .when(F.try_parse_json(F.col(text)).isNull(), C.NOT_JSON)
        .when(~F.coalesce(filled(F.from_json(text, form)), F.lit(False)), C.NO_RECORDS)
    )
    others = [c for c in docs.columns if c != text]
    return docs.select(*others, reason.alias("reason"), text).where("reason IS NOT NULL")


# --- daily quotes -------------------------------------------------------------------------------


def read_quotes_json(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """Flat quote records, every field text: files that each hold an array, or one record per line."""
    return spark.read.schema(S.RAW_QUOTES).option("multiLine", not per_line).json(path)


def parse_quotes(docs: DataFrame, symbol: str = "symbol", text: str = "value") -> DataFrame:
    """Quote documents to flat text records.

    ``docs`` has the requested symbol next to the document. An absent or empty quote gives no row;
    a field that is missing from a quote gets its default.
    """
    extra = [c for c in docs.columns if c not in (symbol, text)]
    # Filtering inside the generator keeps it to one parse per document.
    filled = F.filter(F.array(F.from_json(text, S.QUOTE_DOC)["Global Quote"]), lambda q: F.size(q) > 0)
    quotes = docs.select(*extra, symbol, F.explode(filled).alias("q"))

    def field(name: str, key: str, default: str | None) -> Column:
        return F.coalesce(F.try_element_at("q", F.lit(key)), F.col(symbol) if default is None else F.lit(default)).alias(name)

    return quotes.select(*extra, *[field(*f) for f in C.QUOTE_FIELDS])


def normalise_quotes(raw: DataFrame, stamp: Stamp = None) -> DataFrame:
    """Typed quotes with the percent change recomputed. Unreadable numbers become NULL for the checks to report."""
    known = {f.name for f in S.RAW_QUOTES}
    extra = [c for c in raw.columns if c not in known]
    typed = raw.select(
        *extra,
        "symbol",
        *[F.col(c).try_cast("double").alias(c) for c in ("price", "previous_close", "change")],
        F.col("volume").try_cast("bigint").alias("volume"),
        "trading_day",
        iso_stamp(stamp).alias("timestamp"),
    )
    return typed.withColumn("change_percent", change_percent("change", "previous_close"))


# --- macro series -------------------------------------------------------------------------------


def read_macro_json(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    return parse_macro(read_documents(spark, path, per_line))


def parse_macro(docs: DataFrame, text: str = "value") -> DataFrame:
    """Documents keyed by series to ``(series_id, description, units, pos, date, raw_value)``."""
    series = docs.select(F.explode(F.from_json(text, S.MACRO_DOC)).alias("key", "s"))
    return series.select(
        F.coalesce("s.series_id", "key").alias("series_id"),
        "s.description",
        "s.units",
        F.posexplode("s.observations").alias("pos", "o"),
    ).select("series_id", "description", "units", "pos", "o.date", F.col("o.value").alias("raw_value"))


def macro_records(parsed: DataFrame, stamp: Stamp = None, missing: str = ".") -> DataFrame:
    """Observations with a value, typed, with year and month taken from the date."""
    day = parse_date("date")
    return parsed.where(F.col("raw_value") != missing).select(
        "series_id",
        "description",
        "units",
        "date",
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.col("raw_value").try_cast("double").alias("value"),
        iso_stamp(stamp).alias("extracted_at"),
    )


def macro_missing_counts(parsed: DataFrame, missing: str = ".") -> DataFrame:
    """Per series the kept and the dropped observations."""
    return parsed.groupBy("series_id").agg(
        F.count_if(F.col("raw_value") != missing).alias("kept"),
        F.count_if(F.col("raw_value") == missing).alias("dropped"),
    )


# --- company facts ------------------------------------------------------------------------------


def read_xbrl_json(spark: SparkSession, path: str, tags: list[str] | None = None, per_line: bool = False) -> DataFrame:
    return parse_xbrl(read_documents(spark, path, per_line), tags)


def parse_xbrl(
    docs: DataFrame, tags: list[str] | None = None, text: str = "value", taxonomy: str = "us-gaap", unit: str = "USD"
) -> DataFrame:
    """Documents keyed by company to one row per filing: ``(symbol, cik, tag, pos, fp, form, fy, val, end, filed)``.

    With ``tags`` the parser keeps the filings of those tags, this taxonomy and this unit only and passes over all else while it reads, so a
    large document costs what is asked of it; without, a document becomes one map of everything it holds. A missing taxonomy,
    tag or unit gives no rows. Positions begin anew in every document, so the columns that tell documents apart, such as ``path``, are kept.
    """
    extra = [c for c in docs.columns if c != text]
    if tags is None:
        company = docs.select(*extra, F.explode(F.from_json(text, S.XBRL_DOC)).alias("symbol", "c"))
        facts = F.try_element_at("c.facts", F.lit(taxonomy))
        by_tag = company.select(*extra, "symbol", "c.cik", F.explode(facts).alias("tag", "t"))
        filings = F.try_element_at("t.units", F.lit(unit))
    elif not tags:
        return parse_xbrl(docs, None, text, taxonomy, unit).where(F.lit(False))
    else:
        wanted = list(dict.fromkeys(tags))
        company = docs.select(*extra, F.explode(F.from_json(text, S.picked_facts(wanted, taxonomy, unit))).alias("symbol", "c"))
        by_name = F.col("c.facts").getField(taxonomy)
        entries = F.array(*[F.struct(F.lit(t).alias("tag"), by_name.getField(t).getField("units").getField(unit).alias("filings")) for t in wanted])
        by_tag = company.select(*extra, "symbol", "c.cik", F.inline(entries))
        filings = F.col("filings")
    return by_tag.select(*extra, "symbol", "cik", "tag", F.posexplode(filings).alias("pos", "f")).select(
        *extra, "symbol", "cik", "tag", "pos", "f.*"
    )


# --- monthly prices -----------------------------------------------------------------------------


def read_monthly_json(
    spark: SparkSession, path: str, symbol: Column, start: str | date, end: str | date, stamp: Stamp = None,
    per_line: bool = False,
) -> DataFrame:
    docs = read_documents(spark, path, per_line).withColumn("symbol", symbol)
    return parse_monthly(docs, start, end, stamp)


def parse_monthly(docs: DataFrame, start: str | date, end: str | date, stamp: Stamp = None, text: str = "value") -> DataFrame:
    """Documents keyed by date to ``(symbol, date, close, volume, extracted_at)`` within the date bounds."""
    months = docs.select(
        "symbol", F.explode(F.from_json(text, S.MONTHLY_DOC)["Monthly Adjusted Time Series"]).alias("date", "m")
    )
    day = parse_date("date")
    return months.where(day.between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))).select(
        "symbol",
        "date",
        F.col("m")["5. adjusted close"].try_cast("double").alias("close"),
        F.col("m")["6. volume"].try_cast("bigint").alias("volume"),
        iso_stamp(stamp).alias("extracted_at"),
    )


def clean_prices(df: DataFrame, start: str | date = C.PRICE_START, date_col: str = "Date", close_col: str = "Close") -> DataFrame:
    """A price frame with its own column names to ``(symbol, date, close)`` from ``start`` on."""
    renamed = df.withColumnsRenamed({date_col: "date", close_col: "close"})
    day = F.to_date("date")
    return renamed.select("symbol", day.alias("date"), "close").where(F.col("date") >= F.lit(str(start)).cast("date"))


def stored_prices(table: DataFrame) -> DataFrame:
    """The stored price table with its ISO text date as DATE."""
    return table.select("symbol", parse_date("date").alias("date"), "close", "volume")


