"""Per-ticker aggregates and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart import bindings as B
from newsmart.catalog.registry import (
    ANALYSES,
    DIM,
    KEPT,
    NEWS,
    at,
    at_sql,
    company,
    query,
)
from newsmart.functions.companies import company_dimension
from newsmart.operators import aggregate
from newsmart.operators.enrich import join_company as join_dimension
from newsmart.plans.news import aggregate_news, process_news


def kept_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed news, one row per content."""
    minute_later = F.col("timestamp") + F.expr("interval 1 minute")
    return process_news(B.news(spark, sf_dir), minute_later)


_SPREAD = "spread as (select * exclude (tickers), unnest(tickers) as ticker from {})"


@query(
    f"""with {NEWS}, {KEPT}, {_SPREAD.format('kept')}
    select ticker, count(*) as article_count from spread group by ticker"""
)
def ticker_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.ticker_counts(kept_news(spark, sf_dir))


@query(
    f"""with {NEWS}, {KEPT}, {_SPREAD.format('kept')}
    select ticker, count(*) as article_count, round(avg(score), 6) as avg_sentiment_score
    from spread group by ticker"""
)
def avg_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = aggregate.ticker_sentiment(kept_news(spark, sf_dir))
    return found.withColumn("avg_sentiment_score", F.round("avg_sentiment_score", 6))


@query(
    f"""with {NEWS}, {KEPT}, {ANALYSES}, {DIM}, spread as (
      select event_id, unnest(tickers) as ticker from kept),
    counted as (
      select ticker, count(*) as article_count from spread group by ticker)
    select ticker, coalesce(company, ticker) as company_name, article_count
    from counted left join dim on upper(ticker) = symbol"""
)
def join_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = aggregate.ticker_counts(kept_news(spark, sf_dir))
    named = join_dimension(counted, company_dimension(spark))
    return named.select("ticker", "company_name", "article_count")


@query(
    f"""with {NEWS}, {KEPT}, {ANALYSES}, votes as (
      select ticker, sentiment, count(*) as n
      from (select event_id, unnest(tickers) as ticker from kept) k
      join analyses on article_event_id = event_id group by ticker, sentiment)
    select ticker, first(sentiment order by n desc, sentiment) as dominant_sentiment,
           cast(sum(n) as bigint) as analysis_count
    from votes group by ticker"""
)
def dominant_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.dominant_sentiment(kept_news(spark, sf_dir), B.analyses(spark, sf_dir))


@query(
    f"""with {NEWS}, {KEPT}, {_SPREAD.format('kept')}, counted as (
      select ticker, to_timestamp(floor(epoch(processed_at) / 300) * 300 + 300) at time zone 'UTC'
               as window_end, min(processed_at) as window_start, count(*) as article_count
      from spread group by 1, 2)
    select ticker, {company('ticker')} as company_name, {at_sql('window_start')},
           {at_sql('window_end')}, article_count from counted"""
)
def snapshot_emit_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.snapshot_by_emit_interval(kept_news(spark, sf_dir)).select(
        "ticker", "company_name", at("window_start"), at("window_end"), "article_count"
    )


@query(
    f"""with {NEWS}, {_SPREAD.format('news')}
    select ticker, {company('ticker')} as company_name,
           {at_sql("date_trunc('hour', ts)", 'window_start')},
           {at_sql("(date_trunc('hour', ts) + interval 1 hour)", 'window_end')},
           count(*) as article_count, round(avg(score), 6) as avg_sentiment_score
    from spread group by ticker, date_trunc('hour', ts)"""
)
def ticker_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(aggregate.tumbling_counts(B.news(spark, sf_dir)))


@query(
    """select event_type as ticker, event_type as company_name,
           strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as window_start,
           strftime(date_trunc('hour', ts) + interval 1 hour, '%Y-%m-%d %H:%M:%S') as window_end,
           count(*) as article_count, round(avg("value"), 9) as avg_sentiment_score
    from events group by event_type, date_trunc('hour', ts)"""
)
def event_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Values have two digits, so means end on a five at the seventh place.
    return _windows(aggregate.tumbling_counts(B.ticker_events(spark, sf_dir)), digits=9)


def _windows(frame: DataFrame, digits: int = 6) -> DataFrame:
    return frame.select(
        "ticker",
        "company_name",
        at("window_start"),
        at("window_end"),
        "article_count",
        F.round("avg_sentiment_score", digits).alias("avg_sentiment_score"),
    )


# The full aggregate: count, mean score and dominant label per ticker and hour.
SNAPSHOTS = f"""{NEWS}, {KEPT}, {ANALYSES}, spread as (
  select event_id, date_trunc('hour', ts) as window_start, score, unnest(tickers) as ticker
  from kept),
votes as (
  select ticker, window_start, sentiment, count(*) as n
  from spread join analyses on article_event_id = event_id group by all),
foremost as (
  select ticker, window_start, first(sentiment order by n desc, sentiment) as dominant_sentiment
  from votes group by all),
counted as (
  select ticker, window_start, count(*) as article_count, avg(score) as avg_sentiment_score
  from spread group by all),
snapshots as (
  select ticker, {company('ticker')} as company_name, window_start,
         window_start + interval 1 hour as window_end, article_count,
         round(avg_sentiment_score, 6) as avg_sentiment_score, dominant_sentiment
  from counted left join foremost using (ticker, window_start))"""

SNAPSHOT_SQL = f"""ticker, company_name, {at_sql('window_start')}, {at_sql('window_end')},
  article_count, avg_sentiment_score, dominant_sentiment"""


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_news(kept_news(spark, sf_dir), B.analyses(spark, sf_dir), "1 hour")


def snapshot_columns() -> list:
    return [
        "ticker",
        "company_name",
        at("window_start"),
        at("window_end"),
        "article_count",
        F.round("avg_sentiment_score", 6).alias("avg_sentiment_score"),
        "dominant_sentiment",
    ]


@query(f"with {SNAPSHOTS} select {SNAPSHOT_SQL} from snapshots")
def ticker_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots(spark, sf_dir).select(*snapshot_columns())
