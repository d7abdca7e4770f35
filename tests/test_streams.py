"""Streams: restarts, fan-out, and agreement with the batch form."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from newsmart import schemas as S
from newsmart.functions.wire import envelope
from newsmart.operators.aggregate import snapshot_by_emit_interval, tumbling_counts
from newsmart.operators.dedup import stream_dedup
from newsmart.plans import news as plans
from newsmart.sinks import tables
from newsmart.sinks.topics import land
from newsmart.sources.tables import drop_versions, read_lake, read_snapshot, read_table
from newsmart.sources.topics import landed_topics
from newsmart.streaming import streams

START = datetime(2024, 1, 1)


def raw(spark, first, last, contents=10):
    rows = [
        (
            f"00000000-0000-0000-0000-{i:012}",
            START + timedelta(minutes=i),
            "synthetic",
            None,
            f"t{i}",
            f"content {i % contents}",
            ["AAPL", "V"][: i % 3],
            '{"overall_sentiment_score": 0.5}',
        )
        for i in range(first, last)
    ]
    return spark.createDataFrame(rows, S.RAW_NEWS)


def send(frame, path):
    land(envelope(frame, S.RAW_NEWS, S.RAW_TOPIC, F.lit("k")), path)


def records(spark, path):
    return plans.raw_records(landed_topics(spark, path))[0]


def processed(spark, path, salts=16, time="processed_at"):
    later = F.col("timestamp") + F.expr("interval 1 minute")
    return plans.process_stream(records(spark, path), later, "1 hour", time, salts)


def test_a_restart_goes_on_where_it_stopped(spark, folder):
    send(raw(spark, 0, 5), f"{folder}/topic")
    for last, expected in [(None, 5), (9, 9), (None, 9)]:
        if last:
            send(raw(spark, 5, last), f"{folder}/topic")
        streams.to_folder(
            records(spark, f"{folder}/topic"), f"{folder}/out", f"{folder}/checkpoint"
        ).awaitTermination()
        assert spark.read.parquet(f"{folder}/out").count() == expected


@pytest.mark.parametrize("salts", [1, 4])
def test_repeats_are_dropped_across_restarts(spark, folder, salts):
    for first, last in [(0, 30), (30, 50)]:
        send(raw(spark, first, last), f"{folder}/topic")
        streams.to_folder(
            processed(spark, f"{folder}/topic", salts), f"{folder}/out", f"{folder}/checkpoint"
        ).awaitTermination()
    kept = spark.read.schema(S.PROCESSED_NEWS).parquet(f"{folder}/out").collect()
    assert sorted(r.content for r in kept) == [f"content {i}" for i in range(10)]
    assert all(r.companies == ["Apple Inc.", "Visa Inc."][: len(r.tickers)] for r in kept)


def test_state_is_given_up_after_the_delay(spark, folder):
    """The second poll moves the watermark past the first; the third counts as new."""
    out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
    for first, last in [(0, 3), (2880, 2883), (2883, 2886)]:
        send(raw(spark, first, last, contents=1), f"{folder}/topic")
        hashed = records(spark, f"{folder}/topic").withColumnRenamed("content", "content_hash")
        deduped = stream_dedup(hashed, "content_hash", "10 minutes", "timestamp", 4)
        streams.to_folder(deduped, out, checkpoint).awaitTermination()
    kept = [r.timestamp.day for r in spark.read.parquet(out).collect()]
    assert sorted(kept) == [1, 3]


def test_dedup_then_windows_in_one_stream(spark, folder):
    """Final windows come out once the watermark has passed them."""
    send(raw(spark, 0, 300, contents=10**6), f"{folder}/topic")
    counted = tumbling_counts(processed(spark, f"{folder}/topic", time="timestamp"))
    streams.to_folder(counted, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    found = spark.read.parquet(f"{folder}/out").collect()
    closed = {r.window_start.hour for r in found}
    assert {0, 1, 2} <= closed and 4 not in closed
    assert {r.article_count for r in found if r.ticker == "AAPL"} == {40}
    assert {r.article_count for r in found if r.ticker == "V"} == {20}


def test_dedup_then_emit_interval_in_one_stream(spark, folder):
    send(raw(spark, 0, 60, contents=10**6), f"{folder}/topic")
    counted = snapshot_by_emit_interval(processed(spark, f"{folder}/topic", salts=2))
    streams.to_aggregates(counted, folder, f"{folder}/checkpoint", None).awaitTermination()
    stored = read_table(spark, f"{folder}/{tables.AGGREGATES}", S.TICKER_AGGREGATE).collect()
    assert sum(r.article_count for r in stored if r.ticker == "AAPL") == 40
    assert sum(r.article_count for r in stored if r.ticker == "V") == 20
    assert all((r.window_end - r.window_start).seconds <= 300 for r in stored)


def test_old_articles_are_not_late_by_arrival(spark, folder):
    """The second poll brings articles days older than the first."""
    for first in (5000, 0):
        send(raw(spark, first, first + 5, contents=10**6), f"{folder}/topic")
        news = plans.process_stream(
            records(spark, f"{folder}/topic"), F.current_timestamp(), "1 minute"
        )
        streams.to_folder(news, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 10


def test_fan_out_has_independent_progress(spark, folder):
    send(raw(spark, 0, 20), f"{folder}/raw")
    later = F.col("timestamp") + F.expr("interval 1 minute")
    batch, _ = plans.raw_records(landed_topics(spark, f"{folder}/raw", streaming=False))
    land(plans.processed_envelopes(plans.process_news(batch, later)), f"{folder}/topic")
    envelopes = landed_topics(spark, f"{folder}/topic")
    news = processed_from(envelopes)
    running = streams.fan_out("all", news, envelopes, folder, f"{folder}/checkpoints")
    assert set(running) == {"tables", "lake"}
    for query in running.values():
        query.awaitTermination()
    articles = read_table(spark, f"{folder}/serving/{tables.ARTICLES}", S.PROCESSED_NEWS)
    lake = read_lake(spark, f"{folder}/lake")
    assert articles.count() == 10
    assert {r.event_id for r in lake.collect()} == {r.event_id for r in articles.collect()}
    again = streams.fan_out("db_sink", news, envelopes, folder, f"{folder}/checkpoints")
    again["tables"].awaitTermination()
    assert articles.count() == 10


def processed_from(envelopes):
    from newsmart.operators.validate import PROCESSED_RULES, accepted, decode

    return accepted(decode(envelopes, PROCESSED_RULES), PROCESSED_RULES)


def test_unknown_sink_selection(spark, folder):
    with pytest.raises(ValueError, match="unknown"):
        streams.fan_out("fax", None, None, folder, folder)


def test_stateful_stream_into_the_lake(spark, folder):
    send(raw(spark, 0, 30), f"{folder}/topic")
    streams.to_lake(
        processed(spark, f"{folder}/topic"),
        f"{folder}/lake",
        f"{folder}/checkpoint",
        every=None,
        stateful=True,
    ).awaitTermination()
    found = read_lake(spark, f"{folder}/lake")
    assert found.select("content_hash").distinct().count() == 10


def test_snapshots_are_read_whole(spark, folder):
    schema = spark.createDataFrame([(1,)], "n long").schema
    assert read_snapshot(spark, folder, schema).count() == 0
    for version in range(1, 13):
        spark.createDataFrame([(version,)], schema).write.parquet(f"{folder}/version={version:012d}")
    # A version that is being written has no mark of success yet.
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = hadoop(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert system.delete(hadoop(f"{folder}/version=000000000012/_SUCCESS"), False)
    assert [r.n for r in read_snapshot(spark, folder, schema).collect()] == [11]
    drop_versions(spark, folder, 3)
    assert [r.n for r in read_snapshot(spark, folder, schema).collect()] == [11]
    left = [s.getPath().getName() for s in system.listStatus(hadoop(folder))]
    assert sorted(left) == [f"version={v:012d}" for v in (9, 10, 11, 12)]


def test_closed_windows_leave_the_state(spark, folder):
    def drop(hours, name):
        rows = spark.createDataFrame([(h,) for h in hours], "h long").select(
            F.timestamp_seconds(F.lit(1_704_067_200) + F.col("h") * 3600).alias("timestamp"),
            F.array(F.lit("AAPL")).alias("tickers"),
            F.lit(None).cast("string").alias("raw_metadata"),
        )
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        return rows.schema

    def follow(schema):
        news = spark.readStream.schema(schema).parquet(f"{folder}/in").withWatermark("timestamp", "1 hour")
        query = streams.to_folder(tumbling_counts(news), f"{folder}/out", f"{folder}/c")
        query.awaitTermination()
        state = query.recentProgress[-1].stateOperators[0].numRowsTotal
        out = spark.read.parquet(f"{folder}/out")
        return state, sorted((r.window_start.hour, r.article_count) for r in out.collect())

    schema = drop([0, 0, 1, 2, 3], "a")
    state, closed = follow(schema)
    assert closed == [(0, 2), (1, 1)] and state == 2
    drop([0, 3, 9], "b")  # the first of them is late
    state, closed = follow(schema)
    assert closed == [(0, 2), (1, 1), (2, 1), (3, 2)] and state == 1
