"""Bulk annotation."""

from __future__ import annotations

import json
import sys
from datetime import datetime

import pytest
from conftest import stamp
from pyspark import cloudpickle
from pyspark.sql import functions as F

from newsmart.catalog.keywords import keyword_annotator
from newsmart import schemas as S
from newsmart.operators.annotate import (
    ask_model,
    parse_replies,
    prompts_for,
)
from newsmart.plans.news import annotate_articles
from newsmart.sources.topics import admission_options

# The models below are defined here, which the workers cannot import.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NOW = "2024-06-01 00:00:00"
GOOD = {
    "summary": "It rose.",
    "sentiment": "bullish",
    "sentiment_confidence": 0.92,
    "entities": [
        {"name": "Apple Inc.", "entity_type": "company", "relevance_score": 0.95},
        {"name": "Tim Cook", "entity_type": "person", "relevance_score": 0.7},
    ],
    "key_topics": ["earnings", "revenue"],
}


ENTITY = GOOD["entities"][0]


def without(*names):
    return {k: v for k, v in GOOD.items() if k not in names}


def parsed(spark, *replies):
    rows = [
        (f"e{i}", r if isinstance(r, str) else json.dumps(r), None, datetime(2024, 6, 1), "m", "1.0")
        for i, r in enumerate(replies)
    ]
    good, dead = parse_replies(spark.createDataFrame(rows, S.REPLY))
    return good.collect(), [r.reason for r in dead.collect()]


def test_a_full_reply(spark):
    (row,), dead = parsed(spark, GOOD)
    assert dead == []
    assert (row.article_event_id, row.summary, row.sentiment) == ("e0", "It rose.", "bullish")
    assert row.sentiment_confidence == 0.92
    assert [e.name for e in row.entities] == ["Apple Inc.", "Tim Cook"]
    assert row.key_topics == ["earnings", "revenue"]
    assert (row.model_id, row.analysis_version) == ("m", "1.0")
    assert row.analyzed_at == datetime(2024, 6, 1)


def test_lists_default_to_empty(spark):
    rows, dead = parsed(spark, without("entities"), without("key_topics"))
    assert dead == []
    assert sorted((len(r.entities), len(r.key_topics)) for r in rows) == [(0, 2), (2, 0)]


@pytest.mark.parametrize("label", S.SENTIMENTS)
def test_all_labels(spark, label):
    assert parsed(spark, {**GOOD, "sentiment": label})[0][0].sentiment == label


@pytest.mark.parametrize(("given", "read"), [(0, 0.0), (1, 1.0), ("0.5", 0.5), (1e-3, 0.001)])
def test_confidence_is_a_number_in_range(spark, given, read):
    assert parsed(spark, {**GOOD, "sentiment_confidence": given})[0][0].sentiment_confidence == read


@pytest.mark.parametrize(
    ("reply", "reason"),
    [
        ({**GOOD, "sentiment": "super_bullish"}, "domain:sentiment"),
        ({**GOOD, "sentiment_confidence": 1.5}, "range:sentiment_confidence"),
        ({**GOOD, "sentiment_confidence": -0.1}, "range:sentiment_confidence"),
        ({**GOOD, "sentiment_confidence": "very"}, "number:sentiment_confidence"),
        ({**GOOD, "entities": [{**ENTITY, "relevance_score": "high"}]}, "number:entities"),
        (without("summary"), "missing:summary"),
        (without("sentiment"), "missing:sentiment"),
        (without("sentiment_confidence"), "missing:sentiment_confidence"),
        ({**GOOD, "entities": [{"name": "A"}]}, "element:entities"),
        ({**GOOD, "entities": "none"}, "malformed"),
        ({**GOOD, "entities": None}, "null:entities"),
        ({**GOOD, "key_topics": None}, "null:key_topics"),
        ("no json here", "malformed"),
    ],
)
def test_bad_replies_are_set_aside(spark, reply, reason):
    rows, dead = parsed(spark, reply)
    assert rows == [] and dead == [reason]


def test_fenced_reply(spark):
    body = json.dumps(GOOD)
    rows, dead = parsed(spark, f"Here:\n```json\n{body}\n```", f"```{body}```")
    assert len(rows) == 2 and dead == []


def test_quoted_score_is_a_number(spark):
    (row,), _ = parsed(spark, {**GOOD, "entities": [{**ENTITY, "relevance_score": "0.25"}]})
    assert row.entities[0].relevance_score == 0.25


def stored(replies):
    return (
        replies.withColumn("analyzed_at", stamp(NOW))
        .withColumn("model_id", F.lit("m"))
        .withColumn("analysis_version", F.lit("1.0"))
    )


def news(spark, n=40):
    return spark.range(n).selectExpr(
        "concat('e', id) as event_id",
        "concat('title ', id) as title",
        "if(id = 7, 'poison', concat('text ', id)) as content",
    )


def poisoned():
    def complete(prompts):
        if any("poison" in p for p in prompts):
            raise RuntimeError("refused")
        return [None if p.startswith("Title: title 9\n") else json.dumps(GOOD) for p in prompts]

    return complete


def test_a_failure_costs_one_article(spark):
    replies = ask_model(prompts_for(news(spark)), poisoned, partitions=2).persist()
    good, dead = parse_replies(stored(replies))
    assert good.count() == 38
    assert {r.article_event_id: r.reason for r in dead.collect()} == {
        "e7": "model_error: refused",
        "e9": "no_reply",
    }


def test_a_model_that_loses_replies_is_caught(spark):
    replies = ask_model(prompts_for(news(spark, 5)), lambda: lambda prompts: ["{}"], partitions=1)
    assert replies.count() == 5


@pytest.fixture
def counted(spark):
    """A model that counts the prompts it is sent."""
    calls = spark.sparkContext.accumulator(0)

    def make():
        def complete(prompts):
            calls.add(len(prompts))
            return [json.dumps(GOOD)] * len(prompts)

        return complete

    return make, calls


def test_an_article_is_sent_once(spark, folder, counted):
    make, calls = counted

    def run(articles, version="1.0"):
        found, dead = annotate_articles(
            articles, folder, make, "m", stamp(NOW), version, partitions=2
        )
        assert found.columns == S.ANALYSIS.fieldNames() and dead.count() == 0
        return found.count()

    assert (run(news(spark, 4)), calls.value) == (4, 4)
    assert (run(news(spark, 4)), calls.value) == (4, 4)  # a replay
    assert (run(news(spark, 6)), calls.value) == (6, 6)  # two new ones
    assert (run(news(spark, 6), "2.0"), calls.value) == (6, 12)


def test_a_failed_article_is_sent_again(spark, folder, counted):
    found, dead = annotate_articles(news(spark, 8), folder, poisoned, "m", stamp(NOW))
    assert found.count() == 7
    assert [r.article_event_id for r in dead.collect()] == ["e7"]
    make, calls = counted
    found, dead = annotate_articles(news(spark, 8), folder, make, "m", stamp("2024-06-02 00:00:00"))
    assert (found.count(), dead.count(), calls.value) == (8, 0, 1)


def test_attempts_are_bounded(spark, folder, counted):
    for _ in range(3):
        annotate_articles(news(spark, 8), folder, poisoned, "m", stamp(NOW), max_attempts=3)
    make, calls = counted
    found, dead = annotate_articles(news(spark, 8), folder, make, "m", stamp(NOW), max_attempts=3)
    assert (found.count(), dead.count(), calls.value) == (7, 1, 0)


@pytest.mark.parametrize(
    ("text", "label", "confidence"),
    [
        ("up up down", "bullish", 0.666667),
        ("DOWN", "bearish", 1.0),
        ("up down", "mixed", 0.5),
        ("upward", "neutral", 1.0),
    ],
)
def test_keyword_annotator(spark, text, label, confidence):
    articles = spark.createDataFrame([("e", "t", text)], "event_id string, title string, content string")
    replies = ask_model(prompts_for(articles), keyword_annotator(["up"], ["down"]))
    (row,) = parse_replies(stored(replies))[0].collect()
    assert (row.sentiment, row.sentiment_confidence) == (label, confidence)


def test_prompts_are_cut_before_the_model(spark):
    long = news(spark, 1).withColumn("content", F.repeat(F.lit("x"), F.lit(5000)))
    assert len(prompts_for(long, 100).first().prompt.split("Content: ")[1]) == 100


@pytest.mark.parametrize(
    ("per_minute", "seconds", "rows"), [(50, 60, "50"), (50, 30, "25"), (1, 60, "1")]
)
def test_admission(per_minute, seconds, rows):
    assert admission_options(per_minute, seconds) == {"maxOffsetsPerTrigger": rows}


@pytest.mark.parametrize(("per_minute", "seconds"), [(0, 60), (1, 10), (50, 1)])
def test_a_trigger_too_short_is_refused(per_minute, seconds):
    with pytest.raises(ValueError, match="shorter"):
        admission_options(per_minute, seconds)


def test_a_model_gets_batches_that_stay_small_however_long_the_table(spark):
    def make():
        return lambda prompts: [str(len(prompts))] * len(prompts)

    prompts = spark.range(0, 3500, 1, 1).selectExpr("concat('e', id) as event_id", "'p' as prompt")
    sizes = [int(r.reply) for r in ask_model(prompts, make).collect()]
    assert len(sizes) == 3500 and max(sizes) <= 1000
