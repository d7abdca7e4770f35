"""The lake and the serving tables."""

from __future__ import annotations

import glob
import json
from datetime import datetime, timedelta

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from newsmart import schemas as S
from newsmart.operators.lake import lake_rows, partition_counts
from newsmart.plans import news as plans
from newsmart.sinks import tables
from newsmart.sinks.lake import spread, write_lake
from newsmart.sinks.topics import land
from newsmart.sources.tables import read_lake, read_table
from newsmart.sources.topics import landed_topics
from newsmart.streaming import streams

NOON = datetime(2024, 6, 15, 12)


def uuid(n: int) -> str:
    return f"00000000-0000-0000-0000-{n:012}"


def processed(n, tickers, when=NOON, url="u", digest=None):
    digest = digest or f"hash{n}"
    return (uuid(n), when, "synthetic", url, f"t{n}", f"c{n}", tickers, None, tickers, digest, when)


def news(spark, *rows):
    return spark.createDataFrame(list(rows), S.PROCESSED_NEWS)


def test_one_lake_row_per_ticker_occurrence(spark):
    rows = lake_rows(
        news(
            spark,
            processed(1, ["AAPL", "MSFT"], url=None),
            processed(2, []),
            processed(3, ["AAPL", "AAPL"], NOON + timedelta(hours=12)),
        )
    ).collect()
    assert sorted((r.event_id[-1], r.date, r.ticker) for r in rows) == [
        ("1", "2024-06-15", "AAPL"),
        ("1", "2024-06-15", "MSFT"),
        ("2", "2024-06-15", "UNKNOWN"),
        ("3", "2024-06-16", "AAPL"),
        ("3", "2024-06-16", "AAPL"),
    ]
    assert "raw_metadata" not in rows[0]
    assert {r.source_url for r in rows} == {"", "u"}


def test_lake_layout_and_pruning(spark, folder):
    write_lake(
        news(spark, processed(1, ["AAPL", "BRK/B"]), processed(2, []), processed(3, ["AAPL"])),
        folder,
    )
    made = {p.removeprefix(folder) for p in glob.glob(f"{folder}/date=*/ticker=*")}
    assert made == {
        "/date=2024-06-15/ticker=AAPL",
        "/date=2024-06-15/ticker=BRK%2FB",
        "/date=2024-06-15/ticker=UNKNOWN",
    }
    assert {r.ticker for r in read_lake(spark, folder).collect()} == {"AAPL", "BRK/B", "UNKNOWN"}
    found = read_lake(spark, folder, ticker="AAPL", since="2024-06-15")
    assert found.count() == 2
    scan = plan_of(found.select("event_id"))
    assert "ticker" in scan.split("PartitionFilters")[1].split("]")[0]
    assert "content" not in scan.split("ReadSchema")[1]
    assert read_lake(spark, folder, since="2024-06-16").count() == 0


def test_partition_counts(spark):
    counted = partition_counts(news(spark, processed(1, ["A", "A"]), processed(2, []))).collect()
    assert {(r.date, r.ticker): r.row_count for r in counted} == {
        ("2024-06-15", "A"): 2,
        ("2024-06-15", "UNKNOWN"): 1,
    }


def test_empty_batch_writes_no_partition(spark, folder):
    write_lake(news(spark), folder)
    assert glob.glob(f"{folder}/date=*") == []


def test_a_day_can_be_written_again(spark, folder):
    first = news(spark, processed(1, ["A"]), processed(2, ["A"], NOON + timedelta(days=1)))
    write_lake(first, folder)
    for _ in range(2):
        write_lake(news(spark, processed(3, ["A"])), folder, mode="overwrite")
        found = {(str(r.date), r.event_id[-1]) for r in read_lake(spark, folder).collect()}
        assert found == {("2024-06-15", "3"), ("2024-06-16", "2")}


def test_rows_per_file(spark, folder):
    write_lake(news(spark, *[processed(i, ["A"]) for i in range(25)]), folder, rows_per_file=10)
    assert len(glob.glob(f"{folder}/date=2024-06-15/ticker=A/*.parquet")) == 3


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            name = "spark.sql.adaptive." + key
            before[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, n):
    """A third of the articles under one ticker."""
    rows = spark.range(0, n, 1, 8).selectExpr(
        "string(id) as event_id",
        "timestamp'2024-06-15 12:00:00' as timestamp",
        "'synthetic' as source",
        "'u' as source_url",
        "'t' as title",
        "repeat(sha2(string(id), 256), 4) as content",
        "array(if(id % 3 = 0, 'HOT', concat('T', id % 50))) as tickers",
        "array() as companies",
        "sha2(string(id), 256) as content_hash",
        "timestamp'2024-06-15 12:00:00' as processed_at",
    )
    return rows.withColumn("companies", F.col("tickers"))


def test_hot_partition_is_split_on_write(spark, folder, settings):
    settings(advisoryPartitionSizeInBytes="200kb")
    write_lake(hot(spark, 30_000), folder)
    assert len(glob.glob(f"{folder}/*/ticker=HOT/*.parquet")) > 2
    assert read_lake(spark, folder).count() == 30_000


def several_days(spark):
    tickers = ["A", "B", "C", "D", "E", "F", "G", "H"]
    return news(spark, *[processed(i, tickers, NOON + timedelta(days=i % 5)) for i in range(20)])


def tasks_of_days(folder):
    """Numbers of the tasks that wrote each day's files."""
    found = {}
    for path in glob.glob(f"{folder}/date=*/ticker=*/part-*.parquet"):
        *_, day, _, name = path.split("/")
        found.setdefault(day, set()).add(name.split("-")[1])
    return found


def test_a_day_is_written_by_one_task(spark, folder, settings):
    settings(**{"coalescePartitions.enabled": "false"})
    write_lake(several_days(spark), folder)
    assert [len(tasks) for tasks in tasks_of_days(folder).values()] == [1] * 5
    assert read_lake(spark, folder).count() == 20 * 8


def test_a_stream_writes_a_day_by_one_task(spark, folder, settings):
    settings(**{"coalescePartitions.enabled": "false"})
    several_days(spark).write.parquet(f"{folder}/in")
    arriving = spark.readStream.schema(S.PROCESSED_NEWS).parquet(f"{folder}/in")
    streams.to_lake(arriving, f"{folder}/lake", f"{folder}/checkpoint", every=None).awaitTermination()
    assert [len(tasks) for tasks in tasks_of_days(f"{folder}/lake").values()] == [1] * 5
    assert read_lake(spark, f"{folder}/lake").count() == 20 * 8


def test_hot_partition_is_spread_where_plans_are_fixed(spark, folder, settings):
    settings(enabled="false")
    rows = spread(lake_rows(hot(spark, 3000)), 8).withColumn("task", F.spark_partition_id())
    assert rows.where("ticker = 'HOT'").select("task").distinct().count() > 1
    assert rows.count() == 3000


def stored(spark, root, name, schema):
    return read_table(spark, f"{root}/{name}", schema)


def test_insert_ignore_and_replay(spark, folder):
    first = news(spark, processed(1, []), processed(2, [], digest="hash1"), processed(3, []))
    tables.write_articles(first, folder, "b0")
    second = news(spark, processed(3, []), processed(4, []), processed(5, [], digest="hash1"))
    for _ in range(2):  # the second time is a replay
        clashes = tables.write_articles(second, folder, "b1")
        articles = stored(spark, folder, tables.ARTICLES, S.PROCESSED_NEWS)
        assert sorted(r.event_id[-1] for r in articles.collect()) == ["1", "3", "4"]
        assert clashes.count() == 0


def test_a_taken_id_is_a_dead_letter(spark, folder):
    tables.write_articles(news(spark, processed(1, [])), folder, "b0")
    (clash,) = tables.write_articles(news(spark, processed(1, [], digest="new")), folder, "b1").collect()
    assert (clash.topic, clash.reason) == (S.PROCESSED_TOPIC, "event_id_taken")
    assert json.loads(clash.value)["content_hash"] == "new"
    articles = stored(spark, folder, tables.ARTICLES, S.PROCESSED_NEWS).collect()
    assert [r.content_hash for r in articles] == ["hash1"]


def test_table_nobody_wrote_is_empty(spark, folder):
    empty = stored(spark, folder, "nothing", S.ANALYSIS)
    assert empty.count() == 0 and empty.columns == S.ANALYSIS.fieldNames()


@pytest.fixture
def envelopes(spark, folder):
    """One batch over all topics, with an orphan, a bad record and a tombstone."""
    articles = news(spark, processed(1, ["AAPL"]), processed(2, []))
    aggregates = spark.createDataFrame(
        [("AAPL", "Apple Inc.", NOON, NOON + timedelta(hours=1), 1, 0.5, "mixed")],
        S.TICKER_AGGREGATE,
    )
    analyses = spark.createDataFrame(
        [(uuid(n), "s", "mixed", 0.5, [], [], NOON, "m", "1.0") for n in (1, 9)], S.ANALYSIS
    )
    odd = spark.createDataFrame(
        [
            (S.PROCESSED_TOPIC, "k", "{broken"),
            (S.ANALYSIS_TOPIC, None, None),
            ("another-topic", "k", "{}"),
        ],
        S.ENVELOPE,
    )
    path = f"{folder}/topics"
    for frame in (
        plans.processed_envelopes(articles),
        plans.aggregate_envelopes(aggregates),
        plans.analysis_envelopes(analyses),
        odd,
    ):
        land(frame, path)
    return landed_topics(spark, path, streaming=False)


def test_dispatch_by_topic(spark, folder, envelopes):
    keys = {(r.topic, r.key) for r in envelopes.collect()}
    assert (S.PROCESSED_TOPIC, "UNKNOWN") in keys
    assert (S.AGGREGATION_TOPIC, "AAPL") in keys
    assert (S.ANALYSIS_TOPIC, None) in keys
    for _ in range(2):  # the second time is a replay
        tables.write_topics(envelopes, folder, "b0")
        assert stored(spark, folder, tables.ARTICLES, S.PROCESSED_NEWS).count() == 2
        (aggregate,) = stored(spark, folder, tables.AGGREGATES, S.TICKER_AGGREGATE).collect()
        assert (aggregate.window_start, aggregate.dominant_sentiment) == (NOON, "mixed")
        (analysis,) = stored(spark, folder, tables.ANALYSES, S.ANALYSIS).collect()
        assert analysis.article_event_id == uuid(1)
        dead = stored(spark, folder, tables.DEAD, S.DEAD_LETTER).collect()
        assert {(r.topic, r.reason) for r in dead} == {
            (S.ANALYSIS_TOPIC, "no_such_article"),
            (S.PROCESSED_TOPIC, "malformed"),
            ("another-topic", "unknown_topic"),
        }
        assert len(dead) == 3


def analysis(n):
    return (uuid(n), "s", "mixed", 0.5, [], [], NOON, "m", "1.0")


def test_an_analysis_before_its_article_is_stored_later(spark, folder):
    early = plans.analysis_envelopes(spark.createDataFrame([analysis(1), analysis(2)], S.ANALYSIS))
    tables.write_topics(early, folder, "b0")
    assert stored(spark, folder, tables.ANALYSES, S.ANALYSIS).count() == 0
    tables.write_articles(news(spark, processed(1, [])), folder, "b1")
    for name in ("retry0", "retry0", "retry1"):
        tables.retry_orphans(spark, folder, name)
        (found,) = stored(spark, folder, tables.ANALYSES, S.ANALYSIS).collect()
        assert found.article_event_id == uuid(1)


def test_writers_keep_out_of_each_others_batches(spark, folder):
    schema = S.TICKER_AGGREGATE
    row = ("A", "A", NOON, NOON, 1, None, None)
    for name in ("one-0", "two-0", "one-0"):
        tables.write_aggregates(spark.createDataFrame([row], schema), folder, name)
    assert stored(spark, folder, tables.AGGREGATES, schema).count() == 2
