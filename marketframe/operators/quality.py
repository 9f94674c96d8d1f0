"""Data-quality checks: reports as DataFrames, and guards that raise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe import constants as C

QUOTE_FIELDS = ("symbol", "price", "volume", "change_percent")
RULE_PATTERN = rf": ({C.MISSING_FIELD}: \w+|{C.INVALID_PRICE}|{C.INVALID_VOLUME}|{C.SUSPICIOUS_CHANGE})"


class DataQualityError(Exception):
    """A blocking check failed."""


def assert_nonempty(df: DataFrame, message: str) -> DataFrame:
    """Return ``df`` unchanged, or raise when it has no rows. Reads at most one row."""
    if df.isEmpty():
        raise DataQualityError(message)
    return df


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise DataQualityError(f"Missing columns: {missing}")
    return df


def check_quotes(quotes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per violated rule: ``(keep..., symbol, error)``. A missing price breaks two rules."""
    have = set(quotes.columns)

    def field(name: str, type_name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast(type_name)

    who = F.coalesce(field("symbol", "string"), F.lit(C.UNKNOWN_SYMBOL))
    price, volume, change = (
        field("price", "double"), field("volume", "bigint"), field("change_percent", "double"),
    )
    rules = [
        F.when(field(name, "string").isNull(), F.concat(who, F.lit(f": {C.MISSING_FIELD}: {name}")))
        for name in QUOTE_FIELDS
    ]
    rules.append(
        F.when(
            F.coalesce(price, F.lit(0.0)) <= 0,
            F.concat(who, F.lit(f": {C.INVALID_PRICE}: $"), F.coalesce(price.cast("string"), F.lit("0"))),
        )
    )
    rules.append(F.when(volume < 0, F.concat(who, F.lit(f": {C.INVALID_VOLUME}: "), volume.cast("string"))))
    rules.append(
        F.when(
            (change < -50) | (change > 50),
            F.concat(who, F.lit(f": {C.SUSPICIOUS_CHANGE}: "), change.cast("string"), F.lit("%")),
        )
    )
    errors = F.array_compact(F.array(*rules))
    return quotes.select(*keep, who.alias("symbol"), F.explode(errors).alias("error"))


def assert_quotes(quotes: DataFrame, errors_path: str, keep: Sequence[str] = ()) -> DataFrame:
    """Blocking form of ``check_quotes``: every error is stored below ``errors_path``, the exception counts them by rule.

    Nothing is stored when all quotes pass. The counts come from the rows stored.
    """
    assert_nonempty(quotes, C.NO_STOCKS)
    errors, spark = check_quotes(quotes, keep), quotes.sparkSession
    if errors.isEmpty():
        return quotes
    errors.write.mode("overwrite").parquet(errors_path)
    rule = F.regexp_extract("error", RULE_PATTERN, 1)
    counts = spark.read.parquet(errors_path).groupBy(rule.alias("rule")).count().orderBy("rule").collect()  # one row per rule
    raise DataQualityError("; ".join(f"{r.rule}: {r['count']}" for r in counts) + f"; all errors are in {errors_path}")


def check_macro(macro: DataFrame, ranges: DataFrame) -> DataFrame:
    """Per series: row count, nulls, out-of-range values, joined error text and a valid flag.

    ``ranges`` has ``(series_id, low, high)``, bounds included; unlisted series have no range rule.
    Missing columns give one report row, as the values cannot be looked at.
    """
    missing = missing_columns(macro, ("date", "value", "series_id"))
    if missing:
        return macro.agg(
            F.lit(None).cast("string").alias("series_id"),
            F.count("*").alias("row_count"),
            F.lit(None).cast("bigint").alias("null_dates"),
            F.lit(None).cast("bigint").alias("out_of_range"),
            F.lit(f"{C.MISSING_COLUMNS}{missing}").alias("errors"),
            F.lit(False).alias("valid"),
        )
    stats = macro.join(ranges, "series_id", "left").groupBy("series_id", "low", "high").agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("date").isNull()).alias("null_dates"),
        F.count_if((F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))).alias("out_of_range"),
    )
    span = F.format_string("[%s, %s]", F.col("low").cast("string"), F.col("high").cast("string"))
    errors = F.array_compact(
        F.array(
            F.when(F.col("null_dates") > 0, F.lit(C.NULL_VALUES.format("date"))),
            F.when(F.col("series_id").isNull(), F.lit(C.NULL_VALUES.format("series_id"))),
            F.when(
                F.col("out_of_range") > 0,
                F.concat(
                    "series_id", F.lit(C.OUT_OF_RANGE), span, F.lit(": "),
                    F.col("out_of_range").cast("string"), F.lit(" rows"),
                ),
            ),
        )
    )
    return stats.select(
        "series_id", "row_count", "null_dates", "out_of_range",
        F.array_join(errors, "; ").alias("errors"), (F.size(errors) == 0).alias("valid"),
    )


def check_fundamentals(records: DataFrame, drop_null_revenue: bool = True) -> DataFrame:
    """One report row over ``(symbol, year, capex, revenue)``: counts per rule, error text, valid flag."""
    missing = missing_columns(records, ("symbol", "year", "capex", "revenue"))
    if missing:
        return records.agg(
            F.count("*").alias("row_count"),
            *[F.lit(None).cast("bigint").alias(n) for n in (
                "null_symbols", "null_years", "negative_capex", "non_positive_revenue", "capex_exceeds_revenue")],
            F.lit(f"{C.MISSING_COLUMNS}{missing}").alias("errors"),
            F.lit(False).alias("valid"),
        )
    rows = records.dropna(subset=["revenue"]) if drop_null_revenue else records
    stats = rows.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("symbol").isNull()).alias("null_symbols"),
        F.count_if(F.col("year").isNull()).alias("null_years"),
        F.count_if(F.col("capex") < 0).alias("negative_capex"),
        F.count_if(F.col("revenue") <= 0).alias("non_positive_revenue"),
        F.count_if(F.col("capex") >= F.col("revenue")).alias("capex_exceeds_revenue"),
    )

    def counted(name: str, text: str) -> Column:
        return F.when(F.col(name) > 0, F.concat(F.lit(f"{text}: "), F.col(name).cast("string"), F.lit(" rows")))

    errors = F.array_compact(
        F.array(
            F.when(F.col("null_symbols") > 0, F.lit(C.NULL_VALUES.format("symbol"))),
            F.when(F.col("null_years") > 0, F.lit(C.NULL_VALUES.format("year"))),
            counted("negative_capex", "capex < 0"),
            counted("non_positive_revenue", "revenue <= 0"),
            counted("capex_exceeds_revenue", "capex >= revenue"),
        )
    )
    return stats.select("*", F.array_join(errors, "; ").alias("errors"), (F.size(errors) == 0).alias("valid"))


def load_report(expected: DataFrame, loaded: DataFrame, key: str = "symbol") -> DataFrame:
    """Every expected key with ``loaded`` or ``failed``, so one bad feed does not hide the others."""
    present = loaded.select(key).distinct().withColumn("__present", F.lit(True))
    state = F.when(F.col("__present"), "loaded").otherwise("failed")
    return expected.select(key).distinct().join(present, key, "left").select(key, state.alias("status"))


def record_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("records"))


def macro_ranges(spark) -> DataFrame:
    return spark.createDataFrame(C.MACRO_RANGES, "series_id string, low int, high int")
