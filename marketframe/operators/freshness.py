"""Completeness, staleness and the health roll-up. The reference day is always an argument."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe import constants as C
from marketframe.functions import is_weekday
from marketframe.sources.tables import file_inventory, has_files, with_file


def completeness(files: DataFrame, days: DataFrame, expected: int = C.EXPECTED_QUOTES) -> DataFrame:
    """State of each day in ``days(day)`` from its newest file.

    ``files`` has ``(day, path, modified, symbol, price)``, one row per record. Weekends are OK, a day
    without files is a WARNING, a newest file with another record count than ``expected`` an ERROR.
    Prices are gathered only for days in order, so the map never exceeds ``expected`` entries.
    """
    # Everything below reads this one aggregate, no larger than the days times the files and symbols of a day.
    entries = files.groupBy("day", "path", "symbol").agg(
        F.max("modified").alias("modified"), F.count("*").alias("n"), F.max("price").alias("price")
    )
    per_file = entries.groupBy("day", "path").agg(F.max("modified").alias("modified"), F.sum("n").alias("n"))
    newest = per_file.groupBy("day").agg(F.max(F.struct("modified", "path", "n")).alias("latest"))
    state = days.select("day").distinct().join(newest, "day", "left")
    found = F.col("latest.n")
    trading = is_weekday("day")
    graded = state.select(
        "day",
        F.when(~trading, "OK").when(found.isNull(), "WARNING").when(found == expected, "OK").otherwise("ERROR").alias("status"),
        F.when(~trading, F.concat(F.date_format("day", "EEEE"), F.lit(C.NON_TRADING)))
        .when(found.isNull(), F.concat(F.lit(C.NO_DAY), F.date_format("day", "yyyy-MM-dd")))
        .when(found != expected, F.concat(F.lit(C.WRONG_COUNT.format(expected)), found.cast("string")))
        .alias("message"),
        F.when(trading, found).alias("records"),
        F.when(trading & (found == expected), F.col("latest.path")).alias("path"),
        F.when(trading & (found == expected), F.col("latest.modified")).alias("last_update"),
    )
    good = graded.where(F.col("path").isNotNull()).select("day", "path")
    # One entry per symbol: aggregating first keeps the map keys unique.
    quoted = entries.join(good, ["day", "path"]).groupBy("day", "symbol").agg(F.max("price").alias("price"))
    prices = quoted.groupBy("day").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("symbol", "price")))).alias("prices")
    )
    return graded.join(prices, "day", "left").drop("path")


def staleness(files: DataFrame, as_of, limits: DataFrame) -> DataFrame:
    """Age of the newest file per feed against its limit in days.

    ``files`` has ``(feed, path, modified)`` and ``limits`` ``(feed, max_days)``; a feed without files is
    a WARNING too.
    """
    newest = files.groupBy("feed").agg(F.max("modified").alias("last_update"), F.count_distinct("path").alias("partitions"))
    age = F.floor((F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.col("last_update").cast("timestamp"))) / 86400)
    rows = limits.join(newest, "feed", "left").withColumn("days_since_update", age)
    late = F.col("days_since_update") > F.col("max_days")
    return rows.select(
        "feed",
        F.when(F.col("last_update").isNull() | late, "WARNING").otherwise("OK").alias("status"),
        F.when(F.col("last_update").isNull(), F.format_string(C.NO_FEED, "feed"))
        .when(late, F.format_string(C.TOO_OLD, "days_since_update", "max_days"))
        .alias("message"),
        "partitions",
        "days_since_update",
    )


def stored_quotes(rows: DataFrame, day: str = "date") -> DataFrame:
    """The rows of a stored quote table as ``completeness`` wants them: each with the file it lies in and that file's time."""
    return with_file(rows).select(F.to_date(day).alias("day"), "path", "modified", "symbol", "price")


def stored_feeds(spark: SparkSession, roots: Mapping[str, str]) -> DataFrame:
    """The stored files of each feed as ``staleness`` wants them, from the listing alone; a feed without a folder has none."""
    found = spark.createDataFrame([], "feed string, path string, modified timestamp")
    for feed, root in roots.items():
        if has_files(spark, root):
            listed = file_inventory(spark, root).select(F.lit(feed).alias("feed"), "path", "modified")
            found = found.unionByName(listed)
    return found


def health(reports: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """HEALTHY when every report row is OK, else NEEDS_ATTENTION with the issues; overall or per ``by``, such as the as-of day.

    Each report has ``(by..., feed, status, message)``, one row per monitored feed.
    """
    rows = reduce(DataFrame.unionByName, [r.select(*by, "feed", "status", "message") for r in reports])
    issue = F.when(F.col("status") != "OK", F.concat_ws(": ", "feed", "message"))
    return rows.groupBy(*by).agg(
        F.when(F.coalesce(F.every(F.col("status") == "OK"), F.lit(True)), "HEALTHY").otherwise("NEEDS_ATTENTION").alias("health"),
        F.count_if(F.col("status") != "OK").alias("n_issues"),
        F.array_join(F.array_sort(F.collect_list(issue)), "; ").alias("issues"),
    )


def default_limits(spark) -> DataFrame:
    return spark.createDataFrame(C.STALENESS_LIMITS, "feed string, max_days int")
