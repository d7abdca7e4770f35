"""The pipelines from raw records to processed news, aggregates and analyses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from newsmart import schemas as S
from newsmart.functions.text import routing_key
from newsmart.functions.wire import envelope
from newsmart.operators.aggregate import ticker_snapshots
from newsmart.operators.annotate import Complete, ask_model, parse_replies, prompts_for
from newsmart.operators.dedup import dedup_content, first_in_place, first_per_key, stream_dedup
from newsmart.operators.enrich import to_processed, with_content_hash
from newsmart.operators.validate import RAW_RULES, accepted, decode, rejected, with_event_id
from newsmart.session import stored
from newsmart.sources.tables import read_replies


def raw_records(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw topic values as (raw news, dead letters)."""
    decoded = decode(values, RAW_RULES)
    return with_event_id(accepted(decoded, RAW_RULES)), rejected(decoded)


def process_news(raw: DataFrame, processed_at: Column, in_place: bool = False) -> DataFrame:
    """Raw news as processed news: hash, drop repeated content, add companies.

    ``in_place`` leaves articles whose content stands once where they are read, for the
    price of reading ``raw`` three times: for tables whose text is too large to shuffle.
    """
    hashed = with_content_hash(raw)
    if in_place:
        kept = first_in_place(hashed, "content_hash", ["timestamp", "event_id"])
    else:
        kept = dedup_content(hashed)
    return to_processed(kept, processed_at)


def process_stream(
    raw: DataFrame,
    processed_at: Column,
    delay: str = "1 hour",
    time: str = "processed_at",
    salts: int = 16,
) -> DataFrame:
    """The same on a stream; repeats are recognised within ``delay`` of ``time``.

    By processing time nothing is late.  ``time="timestamp"`` carries the event
    time on, which event-time windows further down the stream need.
    """
    hashed = with_content_hash(raw).withColumn("processed_at", processed_at)
    kept = stream_dedup(hashed, "content_hash", delay, time, salts)
    return to_processed(kept, F.col("processed_at"))


def aggregate_news(processed: DataFrame, analyses: DataFrame, duration: str) -> DataFrame:
    """Processed news and its analyses as ticker aggregates."""
    return ticker_snapshots(processed, analyses, duration)


def raw_envelopes(raw: DataFrame, default_key: str | Column) -> DataFrame:
    """Raw news keyed by first ticker, else by what the feed was asked for."""
    default = F.lit(default_key) if isinstance(default_key, str) else default_key
    key = F.coalesce(F.get("tickers", F.lit(0)), default)
    return envelope(raw, S.RAW_NEWS, S.RAW_TOPIC, key)


def processed_envelopes(processed: DataFrame) -> DataFrame:
    key = routing_key(F.col("tickers"), S.NO_TICKER)
    return envelope(processed, S.PROCESSED_NEWS, S.PROCESSED_TOPIC, key)


def aggregate_envelopes(aggregates: DataFrame) -> DataFrame:
    return envelope(aggregates, S.TICKER_AGGREGATE, S.AGGREGATION_TOPIC, F.col("ticker"))


def analysis_envelopes(analyses: DataFrame) -> DataFrame:
    return envelope(analyses, S.ANALYSIS, S.ANALYSIS_TOPIC, None)


def dead_letter_envelopes(dead: DataFrame) -> DataFrame:
    """Rejected records as dead letters; the reason travels as the key."""
    return dead.select(
        F.lit(S.DEAD_LETTER_TOPIC).alias("topic"), F.col("reason").alias("key"), "value"
    )


def annotate_articles(
    articles: DataFrame,
    replies_path: str,
    make_complete: Callable[[], Complete],
    model_id: str,
    analyzed_at: Column,
    version: str = S.ANALYSIS_VERSION,
    max_chars: int = S.PROMPT_CONTENT_CHARS,
    partitions: int | None = None,
    max_attempts: int = 5,
) -> tuple[DataFrame, DataFrame]:
    """Annotate articles: (analyses, dead letters).

    Answers are added to the table at ``replies_path`` before anything is made
    of them, and an article with a good answer there is not sent again: a replay,
    or reading the result twice, asks the model nothing.  A call that failed is
    made again by the next run, ``max_attempts`` times in all; the newest good
    answer counts, and an article without one is a dead letter.  Prompts are cut to
    size before any shuffle.  ``articles`` is read several times, its ids first:
    pass a stored or persisted frame.
    """
    spark = articles.sparkSession

    def answers() -> DataFrame:
        replies = read_replies(spark, replies_path, model_id, version)
        return replies.withColumnRenamed("article_event_id", "event_id")

    ids = stored(articles.select("event_id").distinct(), "article-ids")
    # Ids and errors only: the replies' text is not read here.
    settled = (
        answers()
        .join(ids, "event_id", "left_semi")
        .groupBy("event_id")
        .agg(F.bool_or(F.col("error").isNull()).alias("good"), F.count("*").alias("attempts"))
        .where(F.col("good") | (F.col("attempts") >= max_attempts))
    )
    todo = prompts_for(articles, max_chars).join(settled, "event_id", "left_anti")
    (
        ask_model(todo, make_complete, partitions)
        .withColumn("analyzed_at", analyzed_at)
        .withColumn("model_id", F.lit(model_id))
        .withColumn("analysis_version", F.lit(version))
        .write.mode("append")
        .partitionBy("model_id", "analysis_version")
        .parquet(replies_path)
    )
    ranked = answers().join(ids, "event_id", "left_semi").withColumn("_failed", F.col("error").isNotNull())
    found = first_per_key(ranked, ["event_id"], ["_failed", F.desc("analyzed_at")]).drop("_failed")
    return parse_replies(found.withColumnRenamed("event_id", "article_event_id"))
