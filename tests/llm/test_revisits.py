"""Revisit resolution against a direct search."""

import random

import pytest
from pyspark.sql import functions as F

from marketframe.llm import revisits

SCHEMA = "record_id long, url string, at long, kind string, status int, headers map<string,string>, url_key int, state string"


@pytest.mark.parametrize(("url", "expected"), [
    ("https://WWW.Example.com:443/A/b/?utm_source=x&b=2&a=1#top", "example.com/A/b?a=1&b=2"),
    ("http://example.com", "example.com"), ("example.com/?ref=1", "example.com"), ("  http://m.example.com/x.html ", "m.example.com/x.html"),
    ("http://example.com/a?b", "example.com/a?b"), ("", ""), ("http://example.com?q=1&&q=0", "example.com?q=0&q=1"),
])
def test_canonical_urls(spark, url, expected):
    assert spark.range(1).select(revisits.canonical_url(F.lit(url))).first()[0] == expected


def direct(rows):
    """State and response of every revisit by looking at all records."""
    result = []
    lower = lambda h: {k.lower(): v for k, v in (h or {}).items()}
    for i, url, at, kind, _, headers, *_ in rows:
        if kind != "revisit":
            continue
        earlier = [
            (r[2], r[0], lower(r[5])) for r in rows
            if r[3] == "response" and r[4] == 200 and None not in (url, at, r[1], r[2]) and r[1] == url and r[2] < at
        ]
        if not earlier:
            result.append((i, None, revisits.MISSING, None))
            continue
        _, response, stored = max(earlier, key=lambda e: e[:2])
        mine = lower(headers)
        tag = lambda h: h["etag"].removeprefix("W/") if "etag" in h else None
        if tag(mine) and tag(stored):
            state = revisits.RESOLVED if tag(mine) == tag(stored) else revisits.CHANGED
        elif "last-modified" in mine and "last-modified" in stored:
            state = revisits.RESOLVED if mine["last-modified"] == stored["last-modified"] else revisits.CHANGED
        else:
            state = revisits.UNCHECKED
        merged = stored | {k: v for k, v in mine.items() if k not in revisits.STORED_ONLY} if state == revisits.RESOLVED else None
        result.append((i, response, state, merged))
    return sorted(result, key=str)


def corpus(seed, hot):
    rnd = random.Random(seed)
    rows = []
    for i in range(600):
        url = "h/hot" if rnd.random() < hot else rnd.choice(["a/x", "b/y", "c/z", None])
        headers = {"Content-Length": str(i)}
        if rnd.random() < 0.7:
            headers["ETag"] = rnd.choice(['"1"', 'W/"1"', '"2"'])
        if rnd.random() < 0.6:
            headers["Last-Modified"] = rnd.choice(["mon", "tue"])
        kind = rnd.choice(["response", "revisit", "revisit", "request"])
        rows.append((
            i, url, rnd.choice([None, *[rnd.randint(0, 300)] * 15]), kind, rnd.choice([200, 200, 304]), rnd.choice([headers, headers, headers, None]), 1, "x"
        ))
    return rows + [r for r in rows if r[3] == "revisit"][:5]


@pytest.mark.parametrize(("seed", "hot"), [(1, 0.2), (2, 0.7), (3, 0.95)])
def test_states_equal_a_direct_search(spark, seed, hot):
    rows = corpus(seed, hot)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = [(r.record_id, r.response_id, r.state, r.headers) for r in revisits.resolve(frame).collect()]
    assert [g[:3] for g in sorted(got, key=lambda g: str(g[:3]))] == [g[:3] for g in sorted(direct(rows), key=lambda g: str(g[:3]))]
    assert {(g[0], str(sorted((g[3] or {}).items()))) for g in got} == {(g[0], str(sorted((g[3] or {}).items()))) for g in direct(rows)}


def test_empty_table_and_header_names(spark):
    assert revisits.resolve(spark.createDataFrame([], SCHEMA)).collect() == []
    frame = spark.createDataFrame([({"ETag": "a", "etag": "b", " Age": "1"},), (None,)], "h map<string,string>")
    got = [r[0] for r in frame.select(revisits.header_map(F.col("h"))).collect()]
    assert got == [{"etag": "b", "age": "1"}, {}]
