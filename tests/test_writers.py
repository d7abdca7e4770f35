"""Several writers of one table, runs after failures, and records that must not get lost."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from newsmart.catalog.keywords import keyword_annotator
from newsmart import schemas as S
from newsmart.functions.wire import encode, envelope
from newsmart.operators.validate import PROCESSED_RULES, accepted, decode, rejected
from newsmart.plans import news as plans
from newsmart.sinks import tables
from newsmart.sinks.lake import write_lake
from newsmart.sinks.topics import land
from newsmart.sources.feeds import market_items, market_records
from newsmart.sources.tables import read_table
from newsmart.sources.topics import landed_topics
from newsmart.streaming import streams

NOON = datetime(2024, 6, 15, 12)


def uuid(n: int) -> str:
    return f"00000000-0000-0000-0000-{n:012}"


def news(spark, *numbers, metadata='{"a": 1}'):
    rows = [
        (uuid(n), NOON + timedelta(minutes=n), "synthetic", f"u{n}", f"t{n}", f"up c{n}", ["AAPL"], metadata, ["Apple"], f"h{n}", NOON)
        for n in numbers
    ]
    return spark.createDataFrame(rows, S.PROCESSED_NEWS)


def analyses(spark, *numbers, version="1.0"):
    rows = [(uuid(n), "s", "bullish", 0.5, [], [], NOON, "m", version) for n in numbers]
    columns = "article_event_id string, summary string, sentiment string, sentiment_confidence double, entities array<struct<name:string,entity_type:string,relevance_score:double>>, key_topics array<string>, analyzed_at timestamp, model_id string, analysis_version string"
    return spark.createDataFrame(rows, columns).select(*S.ANALYSIS.fieldNames())


def send(frame, path):
    land(plans.processed_envelopes(frame), path)


def count(spark, root, name, schema):
    return read_table(spark, f"{root}/{name}", schema).count()


def test_streams_on_one_root_keep_each_others_rows(spark, folder):
    send(news(spark, 1, 2, 3), f"{folder}/one")
    send(news(spark, 4, 5), f"{folder}/two")
    for source, checkpoint in [("one", "a"), ("two", "b"), ("one", "fresh")]:
        envelopes = landed_topics(spark, f"{folder}/{source}")
        streams.to_tables(envelopes, f"{folder}/tables", f"{folder}/{checkpoint}").awaitTermination()
    assert count(spark, f"{folder}/tables", tables.ARTICLES, S.PROCESSED_NEWS) == 5


def test_models_and_fresh_checkpoints_keep_each_others_analyses(spark, folder):
    root = f"{folder}/tables"
    send(news(spark, 1, 2, 3), f"{folder}/topic")
    streams.to_tables(landed_topics(spark, f"{folder}/topic"), root, f"{folder}/t").awaitTermination()
    for model, checkpoint in [("a", "a"), ("b", "b"), ("a", "fresh")]:
        values = landed_topics(spark, f"{folder}/topic")
        articles = accepted(decode(values, PROCESSED_RULES), PROCESSED_RULES)
        make = keyword_annotator(["up"], ["down"])
        streams.to_analyses(articles, root, f"{folder}/{checkpoint}", make, model).awaitTermination()
    stored = read_table(spark, f"{root}/{tables.ANALYSES}", S.ANALYSIS).groupBy("model_id").count()
    assert {r["model_id"]: r["count"] for r in stored.collect()} == {"a": 3, "b": 3}


@pytest.mark.parametrize("version", ["1.0", None])
def test_late_articles_bring_their_analyses_in_once(spark, folder, version):
    record = analyses(spark, 1, 2, version=version)
    value = F.to_json(F.struct(*record.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ssXXX"})  # leaves nulls out
    found = record.select(F.lit(S.ANALYSIS_TOPIC).alias("topic"), F.lit(None).cast("string").alias("key"), value.alias("value"))
    tables.write_topics(found, folder, "first")
    assert count(spark, folder, tables.ANALYSES, S.ANALYSIS) == 0
    tables.write_topics(plans.processed_envelopes(news(spark, 1)), folder, "second")
    for run in range(3):
        tables.retry_orphans(spark, folder, f"retry-{run}")
    stored = read_table(spark, f"{folder}/{tables.ANALYSES}", S.ANALYSIS).collect()
    assert [(r.article_event_id, r.analysis_version) for r in stored] == [(uuid(1), "1.0")]


def test_other_topics_are_dead_letters(spark, folder):
    rows = [("elsewhere", None, "{}"), (None, None, "x"), ("elsewhere", None, None)]
    tables.write_topics(spark.createDataFrame(rows, S.ENVELOPE), folder, "b")
    dead = read_table(spark, f"{folder}/{tables.DEAD}", S.DEAD_LETTER).collect()
    assert sorted((r.value, r.reason) for r in dead) == [("x", "unknown_topic"), ("{}", "unknown_topic")]


@pytest.mark.parametrize(
    "metadata", ['{"a":1,"a":2}', '{"n":123456789012345678901234567890123456789012345}', '{"b":"\\"raw_metadata\\":\\"\\"","a":[]}', None]
)
def test_metadata_goes_out_as_it_came(spark, metadata):
    frame = news(spark, 1, metadata=metadata)
    value = frame.select(encode(S.PROCESSED_NEWS).alias("v")).first()["v"]
    assert f'"raw_metadata":{metadata or "null"}' in value
    assert json.loads(value)["title"] == "t1"
    back = envelope(frame, S.PROCESSED_NEWS, S.PROCESSED_TOPIC, None)
    assert accepted(decode(back, PROCESSED_RULES), PROCESSED_RULES).count() == 1


def test_a_null_feed_is_set_aside(spark):
    rows = [('{"feed": null}',), ('{"feed": []}',), ('{"other": 1}',), ("broken",)]
    decoded = market_items(spark.createDataFrame(rows, "value string"))
    assert sorted(r.value for r in rejected(decoded).collect()) == ["broken", '{"feed": null}']
    assert market_records(decoded).count() == 0


def test_a_lake_has_one_kind_of_writer(spark, folder):
    write_lake(news(spark, 1), f"{folder}/batch")
    with pytest.raises(ValueError, match="batch jobs"):
        streams.to_lake(news(spark, 1), f"{folder}/batch", f"{folder}/c1")
    send(news(spark, 1), f"{folder}/topic")
    values = landed_topics(spark, f"{folder}/topic")
    rows = accepted(decode(values, PROCESSED_RULES), PROCESSED_RULES)
    for _ in range(2):  # a restart goes on
        streams.to_lake(rows, f"{folder}/stream", f"{folder}/c2", every=None).awaitTermination()
    with pytest.raises(ValueError, match="stream"):
        write_lake(news(spark, 2), f"{folder}/stream")
