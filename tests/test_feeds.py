"""Feed scans and normalisation."""

from __future__ import annotations

import json
import os
from datetime import datetime

import pytest
from conftest import stamp
from pyspark.sql import functions as F

from newsmart.functions.text import extract_terms
from newsmart.functions.times import compact_timestamp, entry_timestamp
from newsmart.operators.dedup import dedup_entry, dedup_source_url
from newsmart.operators.normalize import (
    filing_entries_to_raw,
    market_items_to_raw,
    union_sources,
)
from newsmart.operators.validate import rejected
from newsmart.sources import feeds

NOW = "2024-06-01 00:00:00"


def item(**changes):
    base = {
        "title": "Chip maker lifts outlook",
        "url": "https://news.example.org/chip",
        "summary": "The outlook was lifted, AAPL rose.",
        "source": "Wire",
        "time_published": "20231215T143000",
        "authors": ["A. Writer"],
        "overall_sentiment_score": 0.85,
        "overall_sentiment_label": "Bullish",
        "ticker_sentiment": [
            {
                "ticker": t,
                "relevance_score": "0.9",
                "ticker_sentiment_score": "0.8",
                "ticker_sentiment_label": "Bullish",
            }
            for t in ("AAPL", "TSM")
        ],
    }
    base.update(changes)
    return {k: v for k, v in base.items() if v is not ...}


def responses(spark, *bodies):
    rows = [(b if isinstance(b, str) else json.dumps(b),) for b in bodies]
    return spark.createDataFrame(rows, "value string")


def market(spark, *bodies):
    return feeds.market_items(responses(spark, *bodies))


def raw_of(spark, *bodies):
    return market_items_to_raw(feeds.market_records(market(spark, *bodies)), stamp(NOW)).collect()


def test_market_item_becomes_raw_news(spark):
    second = item(url="https://news.example.org/b", authors=..., ticker_sentiment=...)
    first, other = sorted(
        raw_of(spark, {"items": "2", "feed": [item(), second]}), key=lambda r: -len(r.tickers)
    )
    assert first.tickers == ["AAPL", "TSM"] and other.tickers == []
    assert first.source == "alpha_vantage"
    assert first.source_url == "https://news.example.org/chip"
    assert first.content == "The outlook was lifted, AAPL rose."
    assert first.timestamp == datetime(2023, 12, 15, 14, 30)
    metadata = json.loads(first.raw_metadata)
    assert metadata == {
        "overall_sentiment_score": 0.85,
        "overall_sentiment_label": "Bullish",
        "source_domain": "Wire",
        "authors": ["A. Writer"],
    }
    assert json.loads(other.raw_metadata)["authors"] == []


@pytest.mark.parametrize("body", [{}, {"feed": []}, {"items": "0"}])
def test_response_without_feed_has_no_items(spark, body):
    assert market(spark, body).count() == 0


def test_one_bad_item_costs_one_item(spark):
    decoded = market(spark, {"feed": [item(), {"title": "only a title"}]}).persist()
    assert feeds.market_records(decoded).count() == 1
    (dead,) = rejected(decoded).collect()
    assert json.loads(dead.value) == {"title": "only a title"}
    assert "missing:url" in dead.reason


def test_wrong_type_and_unreadable_response_are_set_aside(spark):
    decoded = market(spark, {"feed": [item(overall_sentiment_score="high")]}, "rate limited")
    found = sorted(r.reason for r in rejected(decoded).collect())
    assert found == ["malformed", "number:overall_sentiment_score"]


def test_quoted_score_is_a_number(spark):
    decoded = market(spark, {"feed": [item(overall_sentiment_score="0.25")]})
    assert feeds.market_records(decoded).first().overall_sentiment_score == 0.25


def test_item_with_incomplete_ticker_is_rejected(spark):
    decoded = market(spark, {"feed": [item(ticker_sentiment=[{"ticker": "AAPL"}])]})
    assert [r.reason for r in rejected(decoded).collect()] == ["element:ticker_sentiment"]


def test_reading_a_feed_twice_gives_each_article_once(spark):
    body = {"feed": [item(), item(url="https://news.example.org/b")]}
    decoded = feeds.market_records(market(spark, body, body))
    once = dedup_source_url(market_items_to_raw(decoded, stamp(NOW))).collect()
    assert len(once) == 2
    assert len({r.event_id for r in once}) == 2


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("20231215T143000", datetime(2023, 12, 15, 14, 30)),
        ("invalid-date", None),
        ("20231215T1430", None),
        ("20231315T143000", None),
        (None, None),
    ],
)
def test_compact_timestamp(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(compact_timestamp(F.col("t"))).first()[0] == expected


ATOM = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom">
  <title>Current filings</title>
  <entry>
    <title type="html">8-K - AAPL Inc &amp; Co (Filer)</title>
    <link rel="alternate" href="https://filings.example.org/1.htm"/>
    <id>urn:filing:1</id>
    <updated>2023-12-15T14:30:00-05:00</updated>
    <summary>Filed 8-K on material events.</summary>
  </entry>
  <entry>
    <title>8-K - Unknown Corp (Filer)</title>
    <link rel="self" href="https://filings.example.org/2.atom"/>
    <link href="https://filings.example.org/2.htm"/>
    <link rel="enclosure" href="https://filings.example.org/2.pdf"/>
    <id>urn:filing:2</id>
    <updated>2023-12-15T15:00:00-05:00</updated>
    <summary>Filed 8-K.</summary>
  </entry>
  <entry><link href="https://filings.example.org/3.htm"/></entry>
</feed>
"""


@pytest.fixture
def filings(spark, folder):
    os.makedirs(folder)
    for name in ("poll1.xml", "poll2.xml"):
        with open(f"{folder}/{name}", "w") as out:
            out.write(ATOM)
    entries = feeds.filing_entries(spark.read, folder)
    return filing_entries_to_raw(entries, stamp(NOW), ["aapl", "MSFT"])


def test_filing_entries(filings):
    assert filings.count() == 6
    rows = {r.source_url[-5:]: r for r in dedup_entry(filings).collect()}
    assert len(rows) == 3
    one, two, three = rows["1.htm"], rows["2.htm"], rows["3.htm"]
    assert one.title == "8-K - AAPL Inc & Co (Filer)"
    assert one.timestamp == datetime(2023, 12, 15, 19, 30)
    assert (one.source, one.tickers, two.tickers) == ("sec_edgar", ["AAPL"], [])
    assert json.loads(one.raw_metadata) == {"filing_type": "8-K", "entry_id": "urn:filing:1"}
    assert (three.title, three.content) == ("Untitled SEC Filing", "")
    assert three.timestamp == datetime(2024, 6, 1)


def test_entries_with_neither_id_nor_link_are_one(spark):
    entries = spark.createDataFrame(
        [("a", None, None, None, None, "x"), ("b", None, "", None, None, "y")],
        "title string, link array<struct<_href:string,_rel:string,_type:string>>, id string, updated string,"
        " published string, summary string",
    )
    raw = filing_entries_to_raw(entries, stamp(NOW))
    assert dedup_entry(raw).count() == 1


@pytest.mark.parametrize(
    ("updated", "published", "expected"),
    [
        ("2023-12-15T14:30:00Z", "2020-01-01T00:00:00Z", datetime(2023, 12, 15, 14, 30)),
        ("soon", "2023-12-15T14:30:00+02:00", datetime(2023, 12, 15, 12, 30)),
        (None, "Fri, 15 Dec 2023 14:30:00 GMT", datetime(2023, 12, 15, 14, 30)),
        ("Fri, 15 Dec 2023 14:30:00 +0100", None, datetime(2023, 12, 15, 13, 30)),
        ("", None, None),
    ],
)
def test_entry_timestamp(spark, updated, published, expected):
    frame = spark.createDataFrame([(updated, published)], "u string, p string")
    assert frame.select(entry_timestamp(F.col("u"), F.col("p"))).first()[0] == expected


@pytest.mark.parametrize(
    ("text", "terms", "expected"),
    [
        ("aapl and msft", ["MSFT", "AAPL"], ["MSFT", "AAPL"]),
        ("AAPLX, XAAPL, AAPL_1", ["AAPL"], []),
        ("(AAPL)", ["aapl", "AAPL"], ["AAPL"]),
        ("modèles les", ["LES"], ["LES"]),
        ("modèles", ["LES"], []),
        ("BRK.B rose", ["BRK", "BRK.B", "B"], ["BRK", "BRK.B", "B"]),
        ("BRKXB rose", ["BRK.B"], []),
        ("nothing", [], []),
    ],
)
def test_extract_terms(spark, text, terms, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(extract_terms(F.col("t"), terms)).first()[0] == expected


def test_long_watch_list_finds_the_same(spark):
    frame = spark.createDataFrame([("Ümlaut T7 é T90, T5x T12",)], "t string")
    terms = [f"T{i}" for i in range(100)]
    assert frame.select(extract_terms(F.col("t"), terms)).first()[0] == ["T7", "T12", "T90"]


def test_union_sources(spark):
    raw = market_items_to_raw(
        feeds.market_records(market(spark, {"feed": [item()]})), stamp(NOW)
    )
    frames = {"alpha_vantage": raw, "sec_edgar": raw, "synthetic": raw}
    for selection, expected in [("real", 2), ("ALL", 3), ("fake", 1), ("sec_edgar", 1)]:
        assert union_sources(frames, selection).count() == expected
    with pytest.raises(ValueError, match="unknown"):
        union_sources(frames, "telegraph")
    with pytest.raises(ValueError, match="needs"):
        union_sources({"synthetic": raw}, "real")
