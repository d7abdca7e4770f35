"""Counts, windows and sentiment."""

from __future__ import annotations

from datetime import datetime

from conftest import plan_of

from newsmart.operators import aggregate

NEWS = (
    "event_id string, timestamp timestamp, tickers array<string>, raw_metadata string,"
    " processed_at timestamp"
)
ANALYSES = "article_event_id string, sentiment string"


def at(minute: int, second: int = 0, hour: int = 10) -> datetime:
    return datetime(2024, 1, 1, hour, minute, second)


def score(value) -> str:
    return f'{{"overall_sentiment_score": {value}}}'


def frame(spark, *rows):
    return spark.createDataFrame(
        [(e, t, tickers, meta, t) for e, t, tickers, meta in rows], NEWS
    )


def test_every_occurrence_counts(spark):
    news = frame(
        spark,
        ("a", at(0), ["AAPL", "AAPL", "TSLA"], None),
        ("b", at(1), ["TSLA", "aapl"], None),
        ("c", at(2), [], None),
    )
    counts = {r.ticker: r.article_count for r in aggregate.ticker_counts(news).collect()}
    assert counts == {"AAPL": 2, "TSLA": 2, "aapl": 1}


def test_mean_score_skips_articles_without_one(spark):
    news = frame(
        spark,
        ("a", at(0), ["A"], score(0.5)),
        ("b", at(1), ["A", "B"], None),
        ("c", at(2), ["A"], score("null")),
        ("d", at(3), ["A"], '{"overall_sentiment_score": "high"}'),
        ("e", at(4), ["A"], score(-0.25)),
    )
    found = {r.ticker: r for r in aggregate.ticker_sentiment(news).collect()}
    assert (found["A"].article_count, found["A"].avg_sentiment_score) == (5, 0.125)
    assert (found["B"].article_count, found["B"].avg_sentiment_score) == (1, None)


def test_event_time_hours_close_at_the_start_of_the_next(spark):
    news = frame(
        spark,
        ("a", at(0), ["aapl"], score(1)),
        ("b", at(59, 59), ["aapl"], score(0)),
        ("c", at(0, hour=11), ["aapl"], None),
    )
    found = sorted(aggregate.tumbling_counts(news).collect(), key=lambda r: r.window_start)
    assert [(r.window_start, r.window_end, r.article_count) for r in found] == [
        (at(0), at(0, hour=11), 2),
        (at(0, hour=11), at(0, hour=12), 1),
    ]
    assert [r.avg_sentiment_score for r in found] == [0.5, None]
    assert {r.company_name for r in found} == {"Apple Inc."}


def test_emit_interval_opens_at_first_sight(spark):
    news = frame(
        spark,
        ("a", at(1, 30), ["X"], None),
        ("b", at(4, 59), ["X"], None),
        ("c", at(5), ["X"], None),
        ("d", at(3), ["Y"], None),
    )
    found = aggregate.snapshot_by_emit_interval(news).collect()
    assert sorted(
        (r.ticker, r.window_start, r.window_end, r.article_count, r.company_name) for r in found
    ) == [
        ("X", at(1, 30), at(5), 2, "X"),
        ("X", at(5), at(10), 1, "X"),
        ("Y", at(3), at(5), 1, "Y"),
    ]


def test_dominant_label(spark):
    news = frame(
        spark,
        ("a", at(0), ["A", "B"], None),
        ("b", at(1), ["A"], None),
        ("c", at(2), ["C"], None),
    )
    analyses = spark.createDataFrame(
        [("a", "neutral"), ("a", "bullish"), ("b", "neutral"), ("z", "mixed")], ANALYSES
    )
    found = aggregate.dominant_sentiment(news, analyses).collect()
    assert {r.ticker: (r.dominant_sentiment, r.analysis_count) for r in found} == {
        "A": ("neutral", 3),
        "B": ("bullish", 2),  # a tie goes to the first by name
    }


def test_snapshot_has_every_ticker_with_or_without_analysis(spark):
    news = frame(
        spark,
        ("a", at(0), ["A", "A"], score(0.5)),
        ("b", at(1), ["B"], None),
        ("c", at(1, hour=12), ["A"], None),
    )
    analyses = spark.createDataFrame([("a", "mixed"), ("a", "mixed")], ANALYSES)
    found = {
        (r.ticker, r.window_start.hour): (r.article_count, r.avg_sentiment_score, r.dominant_sentiment)
        for r in aggregate.ticker_snapshots(news, analyses).collect()
    }
    assert found == {
        ("A", 10): (2, 0.5, "mixed"),
        ("B", 10): (1, None, None),
        ("A", 12): (1, None, None),
    }


def test_counts_are_combined_before_the_shuffle(spark):
    news = frame(spark, ("a", at(0), ["A"], None))
    analyses = spark.createDataFrame([("a", "mixed")], ANALYSES)
    for found in (
        aggregate.ticker_counts(news),
        aggregate.tumbling_counts(news),
        aggregate.label_votes(analyses),
    ):
        plan = plan_of(found)
        assert "partial_" in plan and "HashAggregate" in plan
        assert "SortAggregate" not in plan
