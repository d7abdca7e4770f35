"""The query surface."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import plan_of, rows_read
from pyspark.sql import functions as F

from newsmart import schemas as S
from newsmart.operators import serve

START = datetime(2024, 1, 1)
ENTITY = {"name": "A", "entity_type": "company", "relevance_score": 0.5}


def article(event_id, minute, tickers):
    when = START + timedelta(minutes=minute)
    return (event_id, when, "synthetic", None, event_id, "text", tickers, None, tickers, event_id, when)


def analysis(event_id, minute, label="mixed", entities=()):
    when = START + timedelta(minutes=minute)
    return (event_id, "s", label, 0.5, list(entities), [], when, "m", "1.0")


@pytest.fixture
def articles(spark):
    rows = [article(f"e{i:02}", i // 2, ["A", "A"] if i % 2 else ["B"]) for i in range(30)]
    return spark.createDataFrame(rows + [article("z", 0, [])], S.PROCESSED_NEWS)


@pytest.fixture
def analyses(spark):
    rows = [
        analysis("e01", 1, "bullish", [ENTITY, ENTITY]),
        analysis("e01", 9, "bearish"),
        analysis("e02", 2),
        analysis("gone", 3),
    ]
    return spark.createDataFrame(rows, S.ANALYSIS)


def ids(frame):
    return [r.event_id for r in frame.collect()]


def test_pages_are_newest_first_and_meet(articles):
    assert articles.count() == 31
    first = ids(serve.articles_page(articles))
    second = ids(serve.articles_page(articles, offset=10))
    assert first[:4] == ["e28", "e29", "e26", "e27"]
    assert len(set(first + second)) == 20
    assert ids(serve.articles_page(articles, limit=100, offset=30)) == ["z"]
    assert ids(serve.articles_page(articles, limit=100, offset=31)) == []


def test_page_columns(articles):
    assert tuple(serve.articles_page(articles).columns) == S.ARTICLE_VIEW


def test_page_of_a_ticker_is_case_sensitive(articles):
    assert set(ids(serve.articles_page(articles, "B", limit=100))) == {
        f"e{i:02}" for i in range(0, 30, 2)
    }
    assert ids(serve.articles_page(articles, "b")) == []
    assert len(ids(serve.articles_page(articles, "", limit=100))) == 31


@pytest.mark.parametrize("bad", [{"limit": 0}, {"limit": 101}, {"offset": -1}])
def test_page_bounds(articles, bad):
    with pytest.raises(ValueError, match="out of range"):
        serve.articles_page(articles, **bad)


def test_other_bounds(spark, articles):
    with pytest.raises(ValueError):
        serve.latest_for_ticker(articles, "A", 51)
    with pytest.raises(ValueError):
        serve.latest_for_ticker(articles, "A", 0)
    aggregates = spark.createDataFrame([], S.TICKER_AGGREGATE)
    with pytest.raises(ValueError):
        serve.aggregations_page(aggregates, limit=101)


def test_page_is_a_top_k_plan(articles):
    assert "TakeOrderedAndProject" in plan_of(serve.articles_page(articles, offset=5))


def test_latest(articles):
    assert ids(serve.latest_for_ticker(articles, "A", 2)) == ["e29", "e27"]
    per_ticker = serve.latest_per_ticker(articles, 2).collect()
    assert sorted((r.ticker, r.event_id) for r in per_ticker) == [
        ("A", "e27"),
        ("A", "e29"),
        ("B", "e26"),
        ("B", "e28"),
    ]


def test_by_ids(spark, articles):
    assert ids(serve.articles_by_ids(articles, ["e03", "nope"])) == ["e03"]
    assert ids(serve.articles_by_ids(articles, ["nope"])) == []
    wanted = spark.createDataFrame([("e03",), ("e03",), ("e04",)], "event_id string")
    assert sorted(ids(serve.articles_by_ids(articles, wanted))) == ["e03", "e04"]
    long = [f"n{i}" for i in range(1500)] + ["e05"]
    assert ids(serve.articles_by_ids(articles, long)) == ["e05"]


def test_latest_analysis_of_stored_articles(articles, analyses):
    found = serve.article_analysis(articles, analyses).collect()
    assert sorted((r.article_event_id, r.sentiment) for r in found) == [
        ("e01", "bearish"),
        ("e02", "mixed"),
    ]
    assert serve.article_analysis(articles, analyses, "e01").first().sentiment == "bearish"
    assert serve.article_analysis(articles, analyses, "gone").count() == 0


def test_recent_analyses(analyses):
    found = serve.recent_analyses(analyses, 2).collect()
    assert [r.article_event_id for r in found] == ["e01", "gone"]


def test_entities_flatten(analyses):
    rows = serve.entity_rows(analyses).collect()
    assert [(r.article_event_id, r.name, r.relevance_score) for r in rows] == [("e01", "A", 0.5)] * 2


def test_aggregations(spark):
    rows = [
        (t, t, START, START + timedelta(hours=h), 1, None, None)
        for t, h in [("B", 1), ("A", 2), ("A", 1), ("A", 3)]
    ]
    aggregates = spark.createDataFrame(rows, S.TICKER_AGGREGATE)
    page = serve.aggregations_page(aggregates, limit=3).collect()
    assert [(r.ticker, r.window_end.hour) for r in page] == [("A", 3), ("A", 2), ("A", 1)]
    assert [r.ticker for r in serve.aggregations_page(aggregates, "B").collect()] == ["B"]


def test_page_reads_wide_columns_of_recent_rows_only(spark, folder):
    rows = spark.range(0, 200_000, 1, 4).selectExpr(
        "concat('e', id) as event_id",
        "timestamp_seconds(id) as timestamp",
        "'synthetic' as source",
        "'u' as source_url",
        "'t' as title",
        "repeat(sha2(string(id), 256), 4) as content",
        "array('A') as tickers",
        "array('A') as companies",
        "timestamp_seconds(id) as processed_at",
    )
    rows.write.option("parquet.block.size", 1 << 20).parquet(folder)
    page = serve.articles_page(spark.read.parquet(folder), "A", limit=20, offset=10)
    assert [r.event_id for r in page.collect()] == [f"e{199_989 - i}" for i in range(20)]
    assert rows_read(page) < 20_000


def test_lookup_by_id_skips_files_without_it(spark, folder):
    from newsmart.sinks.tables import write_batch

    rows = spark.range(0, 40_000, 1, 8).selectExpr(
        "concat('00000000-0000-0000-0000-', lpad(string(pmod(id * 7919, 40000)), 12, '0')) as event_id",
        "timestamp_seconds(id) as timestamp",
        "'synthetic' as source",
        "'u' as source_url",
        "'t' as title",
        "'c' as content",
        "array('A') as tickers",
        "array('A') as companies",
        "timestamp_seconds(id) as processed_at",
    )
    write_batch(rows, folder, "b0", lookup="event_id")
    wanted = "00000000-0000-0000-0000-000000000005"
    found = serve.articles_by_ids(spark.read.parquet(folder), [wanted])
    assert [r.event_id for r in found.collect()] == [wanted]
    assert rows_read(found) <= 10_000


def test_deep_pages_are_those_of_the_whole_order(spark, articles, monkeypatch):
    for limit, offset in [(5, 0), (7, 3), (10, 20), (100, 25), (4, 29), (10, 31), (10, 500)]:
        assert ids(serve.articles_deep_page(articles, limit=limit, offset=offset)) == ids(
            serve.articles_page(articles, limit=limit, offset=offset)
        )
        monkeypatch.setattr(serve, "_ACCURACY", 10)  # rough bounds are corrected
        assert ids(serve.articles_deep_page(articles, "B", limit=limit, offset=offset)) == ids(
            serve.articles_page(articles, "B", limit=limit, offset=offset)
        )


def test_deep_page_orders_a_span_alone(spark):
    many = spark.range(100_000).select(
        F.concat(F.lit("e"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("event_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("timestamp"),
    )
    inside, newer = serve._span(many, 60_000, 10)
    span = many.where(inside).count()
    assert newer <= 60_000 and newer + span >= 60_010 and span < 500
    ties = many.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    inside, newer = serve._span(ties, 500, 10)
    assert newer == 0 and ties.where(inside).count() == 100_000


def test_pages_by_cursor_meet(articles):
    whole = ids(serve.articles_page(articles, limit=100))
    got, page = [], serve.articles_page(articles, limit=7)
    while rows := page.collect():
        got += [r.event_id for r in rows]
        page = serve.articles_page_after(articles, rows[-1].timestamp, rows[-1].event_id, limit=7)
    assert got == whole
