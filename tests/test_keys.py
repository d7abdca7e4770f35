from __future__ import annotations

import time

import pytest
from conftest import plan_of, rows_read, stamp
from pyspark.sql import functions as F

from newsmart import schemas as S
from newsmart.sinks import tables
from newsmart.sinks.keys import merge_keys, write_keys
from newsmart.sources import keys
from newsmart.sources.tables import read_table


def articles(spark, ids, day="2024-01-01"):
    ids = spark.createDataFrame([(i,) for i in ids], "i long")
    event = F.concat(F.lit("e"), F.col("i"))
    return ids.select(
        event.alias("event_id"),
        stamp(day).alias("timestamp"),
        F.lit("synthetic").alias("source"),
        F.lit(None).cast("string").alias("source_url"),
        F.lit("t").alias("title"),
        F.concat(F.lit("text "), F.col("i")).alias("content"),
        F.array(F.lit("AAPL")).alias("tickers"),
        F.lit(None).cast("string").alias("raw_metadata"),
        F.array(F.lit("Apple Inc.")).alias("companies"),
        F.sha2(F.col("i").cast("string"), 256).alias("content_hash"),
        stamp(day).alias("processed_at"),
    ).select(*S.PROCESSED_NEWS.fieldNames())


def held(spark, root, ids, except_batch=None, key="event_id"):
    wanted = spark.createDataFrame([(f"e{i}",) for i in ids], "event_id string")
    found = keys.stored_keys(wanted, root, tables.ARTICLES, S.PROCESSED_NEWS, key, [key], except_batch)
    return sorted(int(r[0][1:]) for r in found.distinct().collect())


def test_lookup_before_and_after_merging(spark, folder):
    for n in range(3):
        tables.write_articles(articles(spark, range(10 * n, 10 * n + 10)), folder, f"b{n}")
    assert held(spark, folder, [3, 15, 29, 77]) == [3, 15, 29]
    assert held(spark, folder, [3, 15, 29], except_batch="b1") == [3, 29]
    tables.merge_indexes(spark, folder)
    read, indexed = keys.folders(spark, folder, tables.ARTICLES, "event_id")
    assert len(read) == 1 and read[0].startswith(keys.MERGED) and indexed >= {"b0", "b1", "b2"}
    assert held(spark, folder, [3, 15, 29, 77]) == [3, 15, 29]
    assert held(spark, folder, [3, 15, 29], except_batch="b1") == [3, 29]
    tables.write_articles(articles(spark, range(25, 35)), folder, "b3")
    assert merge_keys(spark, folder, tables.ARTICLES, S.PROCESSED_NEWS, "event_id", ["event_id"])
    read, indexed = keys.folders(spark, folder, tables.ARTICLES, "event_id")
    assert len(read) == 1 and indexed >= {"b0", "b1", "b2", "b3"}
    assert held(spark, folder, [3, 15, 34, 35]) == [3, 15, 34]
    assert merge_keys(spark, folder, tables.ARTICLES, S.PROCESSED_NEWS, "event_id", ["event_id"]) is None


def test_rows_without_an_index_are_found(spark, folder):
    """A table older than its index, and a job that ended between its rows and its keys."""
    tables.write_batch(articles(spark, range(5)), f"{folder}/{tables.ARTICLES}", "old")
    assert held(spark, folder, [1, 9]) == [1]
    tables.write_articles(articles(spark, range(3, 8)), folder, "new")
    assert held(spark, folder, [1, 6]) == [1, 6]
    stored = read_table(spark, f"{folder}/{tables.ARTICLES}", S.PROCESSED_NEWS)
    assert stored.count() == 8


def test_a_replay_and_a_merge_in_between(spark, folder):
    tables.write_articles(articles(spark, range(6)), folder, "a")
    tables.write_articles(articles(spark, range(4, 9)), folder, "b")
    tables.merge_indexes(spark, folder)
    tables.write_articles(articles(spark, range(4, 9)), folder, "b")
    stored = read_table(spark, f"{folder}/{tables.ARTICLES}", S.PROCESSED_NEWS)
    assert sorted(r.event_id for r in stored.collect()) == [f"e{i}" for i in range(9)]
    assert held(spark, folder, range(12)) == list(range(9))


def test_null_keys_and_empty_batches(spark, folder):
    tables.write_articles(articles(spark, [1]).limit(0), folder, "empty")
    assert held(spark, folder, [1]) == []
    rows = articles(spark, [1, 2]).withColumn("event_id", F.when(F.col("event_id") == "e1", F.col("event_id")))
    write_keys(rows, folder, tables.ARTICLES, "x", "event_id", ["event_id"])
    assert held(spark, folder, [1, 2]) == [1]


@pytest.fixture
def history(spark, folder):
    """30 batches of keys, merged; no articles behind them."""
    for n in range(30):
        rows = spark.range(n * 2000, n * 2000 + 2000).select(F.concat(F.lit("e"), F.col("id")).alias("event_id"))
        write_keys(rows, folder, tables.ARTICLES, f"b{n}", "event_id", ["event_id"])
    return folder


def test_a_small_batch_reads_its_own_prefixes_alone(spark, history):
    wanted = spark.createDataFrame([("e5",), ("e59999",), ("none",)], "event_id string")

    def look():
        began = time.perf_counter()
        found = keys.stored_keys(wanted, history, tables.ARTICLES, S.PROCESSED_NEWS, "event_id", ["event_id"])
        assert sorted(r[0] for r in found.collect()) == ["e5", "e59999"]
        return found, time.perf_counter() - began

    _, apart = look()
    merge_keys(spark, history, tables.ARTICLES, S.PROCESSED_NEWS, "event_id", ["event_id"])
    found, merged = look()
    plan = plan_of(found)
    assert "PartitionFilters: [prefix" in plan.replace("isnotnull(prefix#", "prefix#").replace("prefix#", "prefix")
    # Three prefixes of 256, each with about 234 of the 60,000 keys.
    assert rows_read(found) < 60_000 * 6 / keys.PREFIXES
    print(f"lookup in 30 folders {apart:.2f} s, merged {merged:.2f} s")
