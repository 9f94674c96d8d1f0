"""Not-modified revisits of a web archive, resolved to the full responses they stand for.

A revisit record says that a page had not changed; its content is that of the latest earlier full response of the same canonical URL. The
validators of both are compared (entity tags weakly, else the modification times), and the headers of the response are brought up to
date by those a not-modified answer may change. The as-of join is one pass in time order within each URL; a URL that outgrows a fair
share of the records is cut along time, and each cut hands its last response on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketframe.operators.ordered import by_segment, find_segments

# Parameters that do not name a page, and headers a not-modified answer leaves as they were stored.
TRACKING = r"^(utm_[^=]*|gclid|fbclid|ref|sessionid)(=|$)"
STORED_ONLY = [
    "content-length", "content-encoding", "content-type", "content-range", "transfer-encoding", "connection", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "te", "trailer", "upgrade",
]
RESOLVED, CHANGED, UNCHECKED, MISSING = "resolved", "validator_mismatch", "no_common_validator", "no_earlier_response"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without a closing slash, other parameters sorted; no scheme or fragment."""
    rest = F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def header_map(headers: Column) -> Column:
    """Names in lower case; of names that differ in case only, the last by code point stays. Null gives no headers."""
    entries = F.transform(
        F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))),
        lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value")),
    )
    last = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]),
    )
    return F.map_from_entries(last)


def merged_headers(stored: Column, newer: Column) -> Column:
    """``stored`` with the values of ``newer`` where these may change."""
    change = F.map_filter(newer, lambda k, _: ~k.isin(STORED_ONLY))
    same = F.map_filter(stored, lambda k, _: ~F.array_contains(F.map_keys(change), k))
    return F.map_concat(same, change)


def _tag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], r"^[Ww]/", "")


def resolve(records: DataFrame) -> DataFrame:
    """``(record_id, url_key, response_id, state, headers)``, one row per revisit record.

    ``records (record_id, url, at, kind, status, headers)``: ``kind`` is "response" or "revisit", ``at`` any ordered time, ``headers``
    map<string,string>. Full responses are those with status 200; equal times are not earlier, and of responses at one time the larger
    ``record_id`` is the later. A null URL or time never meets another record. Repeated revisit rows give one row each; without a
    response the id and the headers are null; other columns are not read; an empty table gives no rows.
    """
    usable = F.col("url").isNotNull() & F.col("at").isNotNull()
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    picked = records.where("kind IN ('response', 'revisit')").where((F.col("kind") == "revisit") | (full & usable)).select(
        "record_id", F.when(usable, canonical_url(F.col("url"))).alias("url_key"), "at", header_map(F.col("headers")).alias("__headers"),
        F.when(full, 1).otherwise(0).alias("__full"), _answer(full).alias("__answer"),
    )
    known, unknown = picked.where("url_key IS NOT NULL"), picked.where("url_key IS NULL")
    segments = find_segments(known, ["url_key"], ["at", "__full", "record_id"])
    rows, by = by_segment(known, ["url_key"], segments)
    # At equal times revisits stand before responses.
    ordered = W.partitionBy(*by).orderBy("at", "__full", "record_id")
    found = rows.withColumn("__last", F.last("__answer", ignorenulls=True).over(ordered))
    if segments is not None:
        segment = by[-1]
        heads = rows.groupBy(*by).agg(F.max_by("__answer", F.when(F.col("__full") == 1, F.struct("at", "record_id"))).alias("__head"))
        before = W.partitionBy("url_key").orderBy(segment).rowsBetween(W.unboundedPreceding, -1)
        carried = heads.withColumn("__before", F.last("__head", ignorenulls=True).over(before)).select(*by, "__before")
        found = found.join(carried, by).withColumn("__last", F.coalesce("__last", "__before"))
    columns = ["record_id", "url_key", F.col("__headers").alias("headers"), F.col("__last").alias("last")]
    revisits = found.where("__full = 0").select(*columns).unionByName(
        unknown.where("__full = 0").withColumn("__last", F.col("__answer")).select(*columns)
    )
    mine, theirs = F.col("headers"), F.col("last.headers")
    tags = _tag(mine).isNotNull() & _tag(theirs).isNotNull()
    times = mine["last-modified"].isNotNull() & theirs["last-modified"].isNotNull()
    state = (
        F.when(F.col("last").isNull(), MISSING)
        .when(tags, F.when(_tag(mine) == _tag(theirs), RESOLVED).otherwise(CHANGED))
        .when(times, F.when(mine["last-modified"] == theirs["last-modified"], RESOLVED).otherwise(CHANGED))
        .otherwise(UNCHECKED)
    )
    return revisits.select(
        "record_id", "url_key", F.col("last.record_id").alias("response_id"), state.alias("state"),
        F.when(F.col("last").isNotNull() & (state == RESOLVED), merged_headers(theirs, mine)).alias("headers"),
    )


def _answer(full: Column) -> Column:
    """The part of a full response that a revisit needs; null elsewhere."""
    return F.when(full, F.struct(F.col("record_id"), header_map(F.col("headers")).alias("headers")))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Archive records of the pages: every page as a response, and a later not-modified answer for it.

    Most answers carry the page's entity tag, some a weak one, only a modification time, or the tag of an older state; some come before
    the page's own capture, so that they meet another capture of the same canonical URL or none.
    """
    p, html = F.col("page_id"), F.coalesce("html", F.lit(""))
    tag = F.concat(F.lit('"'), F.substring(F.md5(html.cast("binary")), 1, 16), F.lit('"'))
    changed = F.concat(F.lit("day "), (p % 30).cast("string"))
    no_text = F.lit(None).cast("string")
    response = F.create_map(
        F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.octet_length(html).cast("string"), F.lit("ETag"), tag,
        F.lit("Last-Modified"), changed, F.lit("Cache-Control"), F.lit("max-age=60"),
    )
    sent_tag = (
        F.when(p % 17 == 0, F.lit('"older"')).when(p % 13 == 0, no_text).when(p % 11 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag)
    )
    answer = F.map_filter(
        F.create_map(
            F.lit("etag"), sent_tag, F.lit("last-modified"), F.when(p % 26 == 0, no_text).otherwise(changed),
            F.lit("cache-control"), F.lit("max-age=120"), F.lit("content-length"), F.lit("0"), F.lit("date"), p.cast("string"),
        ),
        lambda _, v: v.isNotNull(),
    )
    at = p * 10
    visit = F.when(p % 19 == 0, at - 5).otherwise(at + (p % 7) * 100 + 1)

    def records(number: Column, time: Column, kind: str, status: int, headers: Column) -> DataFrame:
        return pages.select(
            number.alias("record_id"), "url", time.alias("at"), F.lit(kind).alias("kind"), F.lit(status).alias("status"),
            headers.alias("headers"),
        )

    return records(p * 2, at, "response", 200, response).unionByName(records(p * 2 + 1, visit, "revisit", 304, answer))


def op7_revisits(spark, sf_dir: str) -> DataFrame:
    found = resolve(records_of_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return found.select("record_id", "url_key", "response_id", "state", F.array_join(lines, "\n").alias("headers"))


def revisits_sql() -> str:
    """The same over ``pages`` in DuckDB's SQL."""
    return rf"""
WITH p AS (
  SELECT page_id, regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest, coalesce(html, '') AS html FROM pages),
c AS (
  SELECT page_id, '"' || substr(md5(html), 1, 16) || '"' AS tag, strlen(html) AS size,
    regexp_replace(lower(regexp_extract(rest, '^([^/?#]*)', 1)), '^www\.|:(80|443)$', '', 'g')
    || regexp_replace(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '/+$', '') AS place,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '{TRACKING}'))), '&') AS query FROM p),
k AS (SELECT *, place || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url_key, 'day ' || (page_id % 30) AS changed FROM c),
responses AS (SELECT url_key, page_id * 10 AS at, page_id * 2 AS id, tag, changed, size FROM k),
revisits AS (
  SELECT url_key, page_id * 2 + 1 AS id, page_id,
    CASE WHEN page_id % 19 = 0 THEN page_id * 10 - 5 ELSE page_id * 10 + (page_id % 7) * 100 + 1 END AS at,
    CASE WHEN page_id % 17 = 0 THEN '"older"' WHEN page_id % 13 = 0 THEN NULL WHEN page_id % 11 = 0 THEN 'W/' || tag ELSE tag END AS tag,
    CASE WHEN page_id % 26 = 0 THEN NULL ELSE changed END AS changed FROM k),
found AS (
  SELECT v.id AS record_id, v.url_key, v.page_id, v.tag AS own_tag, v.changed AS own_changed, r.id AS response_id, r.tag, r.changed, r.size
  FROM revisits v LEFT JOIN LATERAL (
    SELECT * FROM responses r WHERE r.url_key = v.url_key AND r.at < v.at ORDER BY r.at DESC, r.id DESC LIMIT 1) r ON true),
judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN '{MISSING}'
    WHEN own_tag IS NOT NULL THEN CASE WHEN regexp_replace(own_tag, '^[Ww]/', '') = tag THEN '{RESOLVED}' ELSE '{CHANGED}' END
    WHEN own_changed IS NOT NULL THEN CASE WHEN own_changed = changed THEN '{RESOLVED}' ELSE '{CHANGED}' END
    ELSE '{UNCHECKED}' END AS state FROM found)
SELECT record_id, url_key, response_id, state,
  CASE WHEN state = '{RESOLVED}' THEN 'cache-control: max-age=120' || chr(10) || 'content-length: ' || size || chr(10) || 'content-type: text/html'
    || chr(10) || 'date: ' || page_id || chr(10) || 'etag: ' || coalesce(own_tag, tag) || chr(10) || 'last-modified: '
    || coalesce(own_changed, changed) END AS headers FROM judged
"""
