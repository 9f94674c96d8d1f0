import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import rows
from marketframe import constants as C
from marketframe import schemas as S
from marketframe.operators.fundamentals import annual_only, fundamentals
from marketframe.sources import landed

STAMP = "2026-01-01T00:00:00"


def write(path, document):
    Path(path).write_text(json.dumps(document))
    return path


def quote(symbol="NVDA", **changes):
    body = {
        "01. symbol": symbol, "05. price": "875.40", "06. volume": "45000000", "07. latest trading day": "2025-12-31",
        "08. previous close": "860.00", "09. change": "15.40", "10. change percent": "1.79%",
    }
    return {"Global Quote": {k: v for k, v in {**body, **changes}.items() if v is not None}}


def docs(spark, *pairs):
    return spark.createDataFrame([(s, json.dumps(d)) for s, d in pairs], "symbol string, value string")


def test_quote_documents_and_defaults(spark):
    sparse = {"Global Quote": {"05. price": "10.5"}}
    out = landed.parse_quotes(
        docs(spark, ("NVDA", quote()), ("META", {"Global Quote": {}}), ("CRM", {"Note": "limit"}), ("ORCL", sparse))
    ).collect()
    got = {r.symbol: r.asDict() for r in out}
    assert set(got) == {"NVDA", "ORCL"}
    assert got["ORCL"] == {
        "symbol": "ORCL", "price": "10.5", "volume": "0", "trading_day": "", "previous_close": "0", "change": "0", "change_percent": "0%",
    }


def test_normalised_quotes(spark, path):
    raw = [
        {"symbol": "NVDA", "price": "875.40", "previous_close": "860.00", "change": "15.40", "change_percent": "9%", "volume": "45000000", "trading_day": "2025-12-31"},
        {"symbol": "META", "price": "620.00", "previous_close": "615.00", "change": "5.00", "change_percent": "0.81%", "volume": "18000000", "trading_day": "2025-12-31"},
        {"symbol": "NEW", "price": "1.0", "previous_close": "0", "change": "1.0", "change_percent": "0%", "volume": "x", "trading_day": "2025-12-31"},
    ]
    out = {r.symbol: r for r in landed.normalise_quotes(landed.read_quotes_json(spark, write(path("q.json"), raw)), STAMP).collect()}
    assert (out["NVDA"].change_percent, out["META"].change_percent, out["NEW"].change_percent) == (1.79, 0.81, 0.0)
    assert out["NVDA"].volume == 45000000 and out["NEW"].volume is None
    assert out["NVDA"].timestamp == "2026-01-01T00:00:00"


MACRO = {
    "GS10": {
        "series_id": "GS10", "description": "ten years", "units": "percent",
        "observations": [{"date": "2023-01-01", "value": "3.88"}, {"date": "2023-02-01", "value": "3.92"}, {"date": "2023-03-01", "value": "."}],
    },
    "UNRATE": {
        "series_id": "UNRATE", "description": "jobless", "units": "percent",
        "observations": [{"date": "2023-01-01", "value": "3.4"}, {"date": "2023-02-01", "value": "3.6"}],
    },
}


def test_macro_documents(spark, path):
    parsed = landed.read_macro_json(spark, write(path("m.json"), MACRO))
    out = landed.macro_records(parsed, STAMP).collect()
    assert len(out) == 4
    second = next(r for r in out if r.series_id == "GS10" and r.month == 2)
    assert (second.year, second.value, second.units, second.description) == (2023, 3.92, "percent", "ten years")
    assert rows(landed.macro_missing_counts(parsed)) == [("GS10", 2, 1), ("UNRATE", 2, 0)]


def filing(fy, val, fp="FY", form="10-K"):
    return {"fp": fp, "form": form, "fy": fy, "val": val, "end": f"{fy}-12-31", "filed": f"{fy + 1}-02-01"}


def company(cik, **tags):
    return {"cik": cik, "entity_name": "x", "facts": {"us-gaap": {t: {"units": {"USD": fs}} for t, fs in tags.items()}}}


def records(spark, path, document):
    facts = landed.read_xbrl_json(spark, write(path("x.json"), document))
    return fundamentals(annual_only(facts), stamp=STAMP)


FIRST, SECOND, THIRD = C.REVENUE_TAGS


def test_fundamentals_of_one_company(spark, path):
    meta = company(
        "0001326801",
        **{
            C.CAPEX_TAG: [filing(2018, 1), filing(2022, 32_000_000_000), filing(2023, 37_000_000_000), filing(2023, 8, "Q3", "10-Q")],
            FIRST: [filing(2022, 116_609_000_000), filing(2023, 134_902_000_000)],
            SECOND: [filing(2023, 1)],
        },
    )
    out = records(spark, path, {"META": meta}).orderBy("year").collect()
    assert [(r.cik, r.symbol, r.year, r.capex_usd, r.revenue_usd, r.revenue_tag) for r in out] == [
        ("0001326801", "META", 2022, 32_000_000_000, 116_609_000_000, FIRST),
        ("0001326801", "META", 2023, 37_000_000_000, 134_902_000_000, FIRST),
    ]
    assert (out[0].period_end, out[0].filed, out[0].extracted_at) == ("2022-12-31", "2023-02-01", "2026-01-01T00:00:00")


def test_revenue_tag_is_chosen_per_company_and_last_value_wins(spark, path):
    document = {
        "OLD": company("1", **{C.CAPEX_TAG: [filing(2022, 5), filing(2022, 6)], FIRST: [filing(2015, 1)], SECOND: [filing(2022, 9)]}),
        "ALT": company("2", **{C.CAPEX_TAG: [filing(2023, 5)], FIRST: [filing(2023, 1, "Q1")], SECOND: [filing(2023, 7), filing(2023, 999_000_000_000)]}),
        "NONE": company("3", **{C.CAPEX_TAG: [filing(2023, 5)]}),
        "NOCAPEX": company("4", **{FIRST: [filing(2023, 5)]}),
        "EMPTY": {"cik": "5", "entity_name": "e", "facts": {}},
    }
    got = rows(records(spark, path, document), "symbol", "year", "capex_usd", "revenue_usd", "revenue_tag")
    assert got == [
        ("ALT", 2023, 5, 999_000_000_000, SECOND),
        ("NONE", 2023, 5, None, None),
        ("OLD", 2022, 5, None, FIRST),  # the first tag has an annual filing, if an old one
        ("OLD", 2022, 6, None, FIRST),  # both capex filings of the year stay
    ]


def test_parsing_can_be_limited_to_tags(spark, path):
    document = {"A": company("1", **{C.CAPEX_TAG: [filing(2022, 5)], "Other": [filing(2022, 6)]})}
    text = landed.read_documents(spark, write(path("x.json"), document))
    assert landed.parse_xbrl(text, [C.CAPEX_TAG]).count() == 1 and landed.parse_xbrl(text).count() == 2
    assert landed.parse_xbrl(text, []).isEmpty() and landed.parse_xbrl(text, []).columns == landed.parse_xbrl(text).columns


def test_tags_are_picked_while_parsing_and_give_the_same_rows(spark):
    """Asking for tags gives the rows of the whole document with those tags, for gaps, nulls and values of a wrong kind as well."""
    wanted = [C.CAPEX_TAG, "odd`tag.x", "Absent", C.CAPEX_TAG]
    whole = company("1", **{C.CAPEX_TAG: [filing(2022, 5), filing(2023, None)], "odd`tag.x": [filing(2021, 4)], "Other": [filing(2022, 6)] * 500})
    tagless = {"cik": "2", "facts": {"us-gaap": {C.CAPEX_TAG: {"units": {"EUR": [filing(2020, 1)]}}, "Absent": None, "odd`tag.x": {"units": None}}}}
    wrong = company("3", **{C.CAPEX_TAG: [{"fp": "FY", "form": 7, "fy": "x", "val": "many"}, filing(2020, 2)]})
    documents = [
        json.dumps({"A": whole, "B": tagless}), json.dumps({"C": wrong}), json.dumps({"D": {"cik": "4", "facts": {"ifrs-full": {}}}}),
        json.dumps({"E": None, "F": {"cik": None}}), "{}", "[]", "no json", "", None, json.dumps({"A": whole})[:-40],
    ]
    docs = spark.createDataFrame(list(enumerate(documents)), "n int, value string")
    picked = landed.parse_xbrl(docs, wanted)
    plain = landed.parse_xbrl(docs).where(F.col("tag").isin(*wanted))
    assert picked.count() >= 4 and picked.columns == plain.columns
    assert rows(picked) == rows(plain)
    assert "Other" not in picked._jdf.queryExecution().optimizedPlan().toString()


def test_monthly_documents_are_bounded_by_date(spark, path):
    body = {
        "Monthly Adjusted Time Series": {
            d: {"5. adjusted close": c, "6. volume": "10"} for d, c in (("2022-11-30", "1"), ("2022-12-30", "100.0"), ("2023-01-31", "105.5"), ("2030-01-31", "9"))
        }
    }
    symbol = F.regexp_extract("path", "([A-Z]+)[.]json", 1)
    out = landed.read_monthly_json(spark, write(path("NVDA.json"), body), symbol, C.PRICE_START, "2024-01-01", STAMP)
    assert rows(out, "symbol", "date", "close", "volume") == [("NVDA", "2022-12-30", 100.0, 10), ("NVDA", "2023-01-31", 105.5, 10)]
    assert landed.stored_prices(out).schema["date"].dataType.simpleString() == "date"


def test_price_frames_are_renamed_and_cut(spark):
    df = spark.createDataFrame([("A", "2022-11-01 05:00:00", 1.0), ("A", "2022-12-01 05:00:00", 2.0)], "symbol string, Date string, Close double")
    out = landed.clean_prices(df.withColumn("Date", F.col("Date").cast("timestamp")))
    assert [(str(r.date), r.close) for r in out.collect()] == [("2022-12-01", 2.0)]


@pytest.mark.parametrize("text", ["not json", "{}", ""])
def test_unreadable_documents_give_no_rows(spark, text):
    df = spark.createDataFrame([("A", text)], "symbol string, value string")
    assert landed.parse_quotes(df).isEmpty()
    assert landed.parse_macro(df.select("value")).isEmpty()
    assert landed.parse_xbrl(df.select("value")).isEmpty()


def test_documents_that_give_nothing_are_told_with_the_reason(spark):
    texts = [
        None, "  ", "nonsense", '{"GS10": {"series_id": "GS10"', "[1]", "{}", '{"GS10": 5}', '{"GS10": {"series_id": "x"}}', json.dumps(MACRO), "null",
    ]
    frame = spark.createDataFrame([(f"p{i}", t) for i, t in enumerate(texts)], "path string, value string")
    got = {r.path: r.reason for r in landed.rejected(frame, "macro").collect()}
    empty, broken, nothing = "empty document", "not JSON", "no records of this feed"
    assert got == {"p0": empty, "p1": empty, "p2": broken, "p3": broken, **{f"p{i}": nothing for i in (4, 5, 6, 7, 9)}}
    for feed in ("quotes", "company_facts", "monthly_prices"):
        assert landed.rejected(frame, feed).count() == len(texts)
    assert landed.rejected(docs(spark, ("NVDA", quote())), "quotes").count() == 0


def test_a_load_sets_broken_documents_aside_and_goes_on(spark, path):
    from marketframe.plans.loads import load_macro
    from marketframe.sources import tables as stored

    Path(path("in")).mkdir()
    write(path("in/good.json"), MACRO)
    Path(path("in/bad.json")).write_text('{"GS10": ')
    load = load_macro(spark, path("in"), path("macro"), "now")
    row = load.rejected.first()
    assert load.rejected.count() == 1 and row.path.endswith("in/bad.json") and (row.reason, row.value) == ("not JSON", '{"GS10": ')
    assert load.records.count() > 0 and spark.read.parquet(f"{path('macro')}-rejected").count() == 1
    Path(path("in/bad.json")).unlink()
    assert load_macro(spark, path("in"), path("macro"), "now").rejected is None
    assert stored.read_table(spark, S.MACRO, path("macro")).count() == load.records.count()
