"""Per-ticker counts, windows and sentiment.

All grouping is by hash aggregation with a partial step in the map task, so a
hot ticker reaches its reducer as one row per map task.  ``content`` is never
part of these frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsmart import schemas as S
from newsmart.functions.companies import company_name

_LABELS = tuple(sorted(S.SENTIMENTS))


def sentiment_score(raw_metadata: Column) -> Column:
    """Overall score from the metadata; null where absent or not a number."""
    text = F.get_json_object(raw_metadata, "$.overall_sentiment_score")
    return text.try_cast("double")


def by_ticker(news: DataFrame, *columns: str | Column) -> DataFrame:
    """One row per ticker occurrence, with the given columns of its article."""
    return news.select(*columns, F.explode("tickers").alias("ticker"))


def ticker_counts(news: DataFrame) -> DataFrame:
    """Occurrences per ticker; a ticker listed twice counts twice."""
    return by_ticker(news).groupBy("ticker").agg(F.count(F.lit(1)).alias("article_count"))


def ticker_sentiment(news: DataFrame) -> DataFrame:
    """Count and mean score per ticker over the articles that have a score."""
    scored = by_ticker(news, sentiment_score(F.col("raw_metadata")).alias("score"))
    return scored.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("article_count"), F.avg("score").alias("avg_sentiment_score")
    )


def label_votes(analyses: DataFrame) -> DataFrame:
    """Analyses per label and article, one row per article."""
    counts = [F.count_if(F.col("sentiment") == label).alias(label) for label in _LABELS]
    return analyses.groupBy(F.col("article_event_id").alias("event_id")).agg(*counts)


def _leading_label() -> Column:
    """Label with the most votes, alphabetical on ties; null without votes."""

    def entry(place: int, label: str) -> Column:
        return F.struct(
            F.col(label).alias("votes"), F.lit(-place).alias("place"), F.lit(label).alias("label")
        )

    best = F.array_max(F.array(*[entry(i, label) for i, label in enumerate(_LABELS)]))
    return F.when(best["votes"] > 0, best["label"])


def dominant_sentiment(news: DataFrame, analyses: DataFrame) -> DataFrame:
    """Most frequent label per ticker.

    Votes are summed per article before the join and per ticker in one
    aggregate over the four labels, so neither an article with very many
    analyses nor a hot ticker concentrates rows.
    """
    voted = news.select("event_id", "tickers").join(label_votes(analyses), "event_id")
    totals = by_ticker(voted, *_LABELS).groupBy("ticker").agg(
        *[F.sum(label).alias(label) for label in _LABELS]
    )
    return totals.select(
        "ticker",
        _leading_label().alias("dominant_sentiment"),
        sum((F.col(label) for label in _LABELS[1:]), F.col(_LABELS[0])).alias("analysis_count"),
    ).where("dominant_sentiment is not null")


def snapshot_by_emit_interval(news: DataFrame, interval: str = "300 seconds") -> DataFrame:
    """Counts per ticker and emit interval of processing time.

    The window opens when the ticker is first seen in the interval and closes
    when the interval is emitted.  Sentiment is left empty.
    """
    counted = (
        by_ticker(news, "processed_at")
        .groupBy(F.window("processed_at", interval), "ticker")
        .agg(F.count(F.lit(1)).alias("article_count"), F.min("processed_at").alias("window_start"))
    )
    return counted.select(
        "ticker",
        company_name(F.col("ticker")).alias("company_name"),
        "window_start",
        F.col("window.end").alias("window_end"),
        "article_count",
        F.lit(None).cast("double").alias("avg_sentiment_score"),
        F.lit(None).cast("string").alias("dominant_sentiment"),
    )


def tumbling_counts(news: DataFrame, duration: str = "1 hour") -> DataFrame:
    """Count and mean score per ticker and event-time window; works on streams."""
    scored = by_ticker(
        news, "timestamp", sentiment_score(F.col("raw_metadata")).alias("score")
    )
    grouped = scored.groupBy(F.window("timestamp", duration), "ticker").agg(
        F.count(F.lit(1)).alias("article_count"), F.avg("score").alias("avg_sentiment_score")
    )
    return _named(grouped)


def _named(grouped: DataFrame) -> DataFrame:
    # The name is looked up after grouping: once per output row.
    return grouped.select(
        "ticker",
        company_name(F.col("ticker")).alias("company_name"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in grouped.columns if c not in ("window", "ticker")],
    )


def ticker_snapshots(
    news: DataFrame, analyses: DataFrame, duration: str = "1 hour"
) -> DataFrame:
    """The full ticker aggregate: count, mean score and dominant label per window."""
    narrow = news.select(
        "event_id",
        "timestamp",
        "tickers",
        sentiment_score(F.col("raw_metadata")).alias("score"),
    )
    voted = narrow.join(label_votes(analyses), "event_id", "left")
    grouped = (
        by_ticker(voted, "timestamp", "score", *_LABELS)
        .groupBy(F.window("timestamp", duration), "ticker")
        .agg(
            F.count(F.lit(1)).alias("article_count"),
            F.avg("score").alias("avg_sentiment_score"),
            *[F.coalesce(F.sum(label), F.lit(0)).alias(label) for label in _LABELS],
        )
    )
    return _named(grouped.withColumn("dominant_sentiment", _leading_label())).select(
        *S.TICKER_AGGREGATE.fieldNames()
    )
