"""Decoding, validation, record functions and the wire format."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newsmart import schemas as S
from newsmart.functions.companies import company_dimension, company_names
from newsmart.functions.identity import canonical_uuid, derived_event_id
from newsmart.functions.text import content_hash, render_prompt, routing_key, unfence_json
from newsmart.functions.wire import encode
from newsmart.operators.enrich import enrich_from_dimension, join_company
from newsmart.operators.validate import (
    AGGREGATE_RULES,
    ANALYSIS_RULES,
    PROCESSED_RULES,
    RAW_RULES,
    accepted,
    decode,
    rejected,
    with_event_id,
)

EVENT = "550e8400-e29b-41d4-a716-446655440000"


def raw(**changes):
    base = {
        "event_id": EVENT,
        "timestamp": "2024-01-15T10:30:00Z",
        "source": "alpha_vantage",
        "title": "A title",
        "content": "Some text.",
        "tickers": ["AAPL"],
    }
    base.update(changes)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


def read(spark, rules, *values):
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    decoded = decode(frame, rules).persist()
    return accepted(decoded, rules).collect(), [r.reason for r in rejected(decoded).collect()]


@pytest.mark.parametrize(
    "value",
    [
        raw(),
        raw(title=""),
        raw(content=""),
        raw(tickers=[]),
        raw(raw_metadata=None, source_url=None),
        raw(raw_metadata={"test": True}),
        raw(unknown_field=1),
        raw(timestamp="2024-01-15T11:30:00+01:00"),
    ],
)
def test_accepted(spark, value):
    good, reasons = read(spark, RAW_RULES, value)
    assert reasons == []
    assert good[0].timestamp == datetime(2024, 1, 15, 10, 30)
    assert good[0].event_id == EVENT


@pytest.mark.parametrize(
    ("value", "reason"),
    [
        (raw(title=...), "missing:title"),
        (raw(content=...), "missing:content"),
        (raw(tickers=...), "missing:tickers"),
        (raw(title=..., content=None), "missing:title,missing:content"),
        (raw(source="invalid_source"), "domain:source"),
        (raw(source="ALPHA_VANTAGE"), "domain:source"),
        (raw(event_id="42"), "uuid:event_id"),
        (raw(tickers=["AAPL", None]), "element:tickers"),
        (raw(tickers="AAPL"), "malformed"),
        (raw(title=5), "type:title"),
        (raw(title={"a": "b"}, content=True), "type:title,type:content"),
        (raw(tickers=["AAPL", 7]), "type:tickers"),
        (raw(source_url=1), "type:source_url"),
        (raw(timestamp="tomorrow"), "malformed"),
        (raw(raw_metadata=[1]), "object:raw_metadata"),
        ("not valid json", "malformed"),
        (raw()[:-4], "malformed"),
        ("[" + raw() + "]", "malformed"),
        ("", "malformed"),
    ],
)
def test_rejected(spark, value, reason):
    good, reasons = read(spark, RAW_RULES, value)
    assert good == [] and reasons == [reason]


def test_tombstones_carry_no_record(spark):
    good, reasons = read(spark, RAW_RULES, None, raw())
    assert len(good) == 1 and reasons == []


def test_nothing_is_lost_between_the_halves(spark):
    values = [raw(), raw(title=...), "x", raw(source="?"), raw(tickers=[None])]
    good, reasons = read(spark, RAW_RULES, *values)
    assert len(good) + len(reasons) == len(values)


def test_missing_id_is_derived_and_repeats(spark):
    frame = spark.createDataFrame([(raw(event_id=...),), (raw(event_id=..., title="b"),)], "value string")
    ids = [
        [r.event_id for r in with_event_id(accepted(decode(frame, RAW_RULES), RAW_RULES)).collect()]
        for _ in range(2)
    ]
    assert ids[0] == ids[1] and len(set(ids[0])) == 2


def test_derived_id_is_uuid_shaped_and_keeps_parts_apart(spark):
    pattern = r"^[0-9a-f]{8}-[0-9a-f]{4}-8[0-9a-f]{3}-8[0-9a-f]{3}-[0-9a-f]{12}$"
    row = spark.range(1).select(
        derived_event_id(F.lit("ab"), F.lit("c")).rlike(pattern),
        derived_event_id(F.lit("ab"), F.lit("c")) != derived_event_id(F.lit("a"), F.lit("bc")),
    ).first()
    assert row[0] and row[1]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (EVENT.upper(), EVENT),
        (EVENT.replace("-", ""), EVENT),
        ("{" + EVENT + "}", EVENT),
        ("urn:uuid:" + EVENT, EVENT),
        (EVENT[:-1], None),
        (EVENT[:-1] + "g", None),
    ],
)
def test_canonical_uuid(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(canonical_uuid(F.col("t"))).first()[0] == expected


@pytest.mark.parametrize(
    ("tickers", "expected"),
    [
        (["AAPL", "MSFT"], ["Apple Inc.", "Microsoft Corporation"]),
        (["aapl", "Msft"], ["Apple Inc.", "Microsoft Corporation"]),
        (["ZZZZZ", "zz"], ["ZZZZZ", "zz"]),
        (["V", "V"], ["Visa Inc.", "Visa Inc."]),
        ([], []),
    ],
)
def test_companies_by_map_and_by_join(spark, tickers, expected):
    news = spark.createDataFrame([("e1", tickers), ("e2", ["GE"])], "event_id string, tickers array<string>")
    by_map = news.select(company_names(F.col("tickers"))).first()[0]
    joined = enrich_from_dimension(news, company_dimension(spark))
    by_join = {r.event_id: r.companies for r in joined.collect()}
    assert by_map == expected
    assert by_join == {"e1": expected, "e2": ["General Electric Company"]}


def test_company_dimension_has_every_entry(spark):
    dimension = company_dimension(spark)
    assert dimension.count() == 52
    named = join_company(dimension.select(F.lower("ticker").alias("ticker")), dimension)
    assert named.where("company_name = ticker").count() == 0


def test_content_hash(spark):
    found = spark.range(1).select(content_hash(F.lit("test content"))).first()[0]
    assert found == "6ae8a75555209fd6c44157c0aed8016e763ff435a19cf186f76863140143ff72"


@pytest.mark.parametrize(("tickers", "key"), [(["B", "A"], "B"), ([], "UNKNOWN")])
def test_routing_key(spark, tickers, key):
    frame = spark.createDataFrame([(tickers,)], "t array<string>")
    assert frame.select(routing_key(F.col("t"), S.NO_TICKER)).first()[0] == key


def test_prompt_is_cut_to_the_budget(spark):
    found = spark.range(1).select(
        render_prompt(F.lit("T"), F.repeat(F.lit("é"), F.lit(5000)), 100)
    ).first()[0]
    assert found == "Title: T\n\nContent: " + "é" * 100


@pytest.mark.parametrize(
    ("reply", "expected"),
    [
        ('```json\n{"a": 1}\n```', '{"a": 1}'),
        ('```\n{"a": 1}```', '{"a": 1}'),
        ('Sure:\n```json {"a": 1}\n``` and ```x```', '{"a": 1}'),
        ('\n\t {"a": 1} \n', '{"a": 1}'),
        ("plain", "plain"),
        ("```json unfinished", "```json unfinished"),
    ],
)
def test_unfence(spark, reply, expected):
    frame = spark.createDataFrame([(reply,)], "r string")
    assert frame.select(unfence_json(F.col("r"))).first()[0] == expected


def test_wire_round_trip(spark):
    row = (
        EVENT,
        datetime(2024, 6, 15, 12, 0, 0, 123456),
        "synthetic",
        None,
        'Quote " and \\ and é',
        "line\nline\ttab",
        ["AAPL", "AAPL"],
        '{"b": {"c": [1, 2]}, "a": "x"}',
        ["Apple Inc.", "Apple Inc."],
        "0" * 64,
        datetime(2024, 6, 15, 12, 0, 1),
    )
    frame = spark.createDataFrame([row], S.PROCESSED_NEWS)
    value = frame.select(encode(S.PROCESSED_NEWS)).first()[0]
    sent = json.loads(value)
    assert sent["timestamp"] == "2024-06-15T12:00:00.123456Z"
    assert sent["source_url"] is None
    assert sent["raw_metadata"] == {"a": "x", "b": {"c": [1, 2]}}
    good, reasons = read(spark, PROCESSED_RULES, value)
    assert reasons == []
    back = good[0].asDict()
    assert json.loads(back.pop("raw_metadata")) == {"a": "x", "b": {"c": [1, 2]}}
    expected = frame.first().asDict()
    expected.pop("raw_metadata")
    assert back == expected


def analysis(**changes):
    base = {
        "article_event_id": EVENT,
        "summary": "s",
        "sentiment": "bullish",
        "sentiment_confidence": 0.92,
        "entities": [{"name": "A", "entity_type": "company", "relevance_score": 0.9}],
        "key_topics": ["t"],
        "analyzed_at": "2024-01-15T10:30:00Z",
        "model_id": "m",
        "analysis_version": "1.0",
    }
    base.update(changes)
    return json.dumps(base)


@pytest.mark.parametrize(
    ("value", "reasons"),
    [
        (analysis(), []),
        (analysis(sentiment_confidence=0), []),
        (analysis(sentiment_confidence=1), []),
        (analysis(sentiment_confidence=1.5), ["range:sentiment_confidence"]),
        (analysis(sentiment="positive"), ["domain:sentiment"]),
        (analysis(model_id="m" * 101), ["length:model_id"]),
        (analysis(entities=[{"name": "A"}]), ["element:entities"]),
        (analysis(entities=[None]), ["element:entities"]),
        (
            analysis(entities=[{"name": 1, "entity_type": "x", "relevance_score": 0.5}]),
            ["type:entities"],
        ),
    ],
)
def test_analysis_rules(spark, value, reasons):
    assert read(spark, ANALYSIS_RULES, value)[1] == reasons


def test_aggregate_rules(spark):
    base = {
        "ticker": "AAPL",
        "company_name": "Apple Inc.",
        "window_start": "2024-01-15T10:00:00Z",
        "window_end": "2024-01-15T11:00:00Z",
        "article_count": 2,
        "avg_sentiment_score": None,
        "dominant_sentiment": None,
    }
    long = {**base, "ticker": "ABCDEFGHIJK", "dominant_sentiment": "positive"}
    good, reasons = read(spark, AGGREGATE_RULES, json.dumps(base), json.dumps(long))
    assert len(good) == 1 and good[0].article_count == 2
    assert reasons == ["domain:dominant_sentiment,length:ticker"]
