"""The query surface."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart import bindings as B
from newsmart.catalog.registry import (
    ANALYSES,
    ANALYSIS_SQL,
    ARTICLE_SQL,
    KEPT,
    NEWS,
    analysis_columns,
    article_columns,
    query,
)
from newsmart.catalog.tickers import (
    SNAPSHOT_SQL,
    SNAPSHOTS,
    kept_news,
    snapshot_columns,
    snapshots,
)
from newsmart.operators import references, serve


@query(
    f"""with {NEWS}
    select {ARTICLE_SQL} from news order by ts desc, event_id limit 100 offset 20"""
)
def articles_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = serve.articles_page(B.articles(spark, sf_dir), limit=100, offset=20)
    return page.select(*article_columns())


@query(
    f"""with {NEWS}
    select {ARTICLE_SQL} from news where list_contains(tickers, 'AAPL')
    order by ts desc, event_id limit 10"""
)
def articles_page_of_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.articles_page(B.articles(spark, sf_dir), "AAPL").select(*article_columns())


@query(
    f"""with {NEWS}
    select {ARTICLE_SQL} from news order by ts desc, event_id
    limit 100 offset (select count(*) * 2 // 3 from news)"""
)
def articles_deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page two thirds down the order."""
    articles = B.articles(spark, sf_dir)
    page = serve.articles_deep_page(articles, limit=100, offset=articles.count() * 2 // 3)
    return page.select(*article_columns())


@query(
    f"""with {NEWS}, middle as (select ts as last_ts, event_id as last_id from news where list_contains(tickers, 'AAPL')
      order by ts desc, event_id limit 1 offset 5)
    select {ARTICLE_SQL} from news, middle
    where list_contains(tickers, 'AAPL') and (ts < last_ts or (ts = last_ts and event_id > last_id))
    order by ts desc, event_id limit 40"""
)
def articles_page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page that follows the last article of another one."""
    articles = B.articles(spark, sf_dir)
    last = serve.articles_page(articles, "AAPL", limit=1, offset=5).first()
    page = serve.articles_page_after(articles, last["timestamp"], last["event_id"], "AAPL", limit=40)
    return page.select(*article_columns())


@query(f"with {NEWS} select {ARTICLE_SQL} from news where list_contains(tickers, 'aapl')")
def articles_by_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.articles_by_ticker(B.articles(spark, sf_dir), "aapl").select(*article_columns())


@query(
    f"""with {NEWS}
    select {ARTICLE_SQL} from news where list_contains(tickers, 'TSLA')
    order by ts desc, event_id limit 5"""
)
def latest_for_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.latest_for_ticker(B.articles(spark, sf_dir), "TSLA").select(*article_columns())


@query(
    f"""with {NEWS}, spread as (
      select *, unnest(list_distinct(tickers)) as ticker from news)
    select ticker, {ARTICLE_SQL} from spread
    qualify row_number() over (partition by ticker order by ts desc, event_id) <= 5"""
)
def latest_per_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = serve.latest_per_ticker(B.articles(spark, sf_dir))
    return latest.select("ticker", *article_columns())


@query(
    f"""with {NEWS}, {ANALYSES}
    select {ARTICLE_SQL} from news
    where event_id in (select article_event_id from analyses)"""
)
def articles_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = B.analyses(spark, sf_dir).select(F.col("article_event_id").alias("event_id"))
    return serve.articles_by_ids(B.articles(spark, sf_dir), ids).select(*article_columns())


@query(
    f"""with {NEWS}, {KEPT}, {ANALYSES}, latest as (
      select * from analyses qualify row_number() over (
        partition by article_event_id
        order by analyzed_at desc, model_id, analysis_version) = 1)
    select {ANALYSIS_SQL} from latest
    where article_event_id in (select event_id from kept)"""
)
def article_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = serve.article_analysis(kept_news(spark, sf_dir), B.analyses(spark, sf_dir))
    return found.select(*analysis_columns())


@query(
    f"""with {SNAPSHOTS}
    select {SNAPSHOT_SQL} from snapshots
    order by snapshots.window_end desc, ticker, snapshots.window_start limit 100"""
)
def aggregations_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = serve.aggregations_page(snapshots(spark, sf_dir), limit=100)
    return page.select(*snapshot_columns())


@query(
    f"""with {SNAPSHOTS}
    select {SNAPSHOT_SQL} from snapshots where ticker = 'JPM'
    order by snapshots.window_end desc, snapshots.window_start limit 10"""
)
def aggregations_of_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = serve.aggregations_page(snapshots(spark, sf_dir), "JPM")
    return page.select(*snapshot_columns())


@query(
    f"""with {ANALYSES}
    select {ANALYSIS_SQL} from analyses
    order by analyses.analyzed_at desc, article_event_id, analysis_version limit 10"""
)
def recent_analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.recent_analyses(B.analyses(spark, sf_dir)).select(*analysis_columns())


@query(
    f"""with {ANALYSES}, pairs as (
      select article_event_id, unnest(list_slice([
        {{'name': (['AAPL','MSFT','aapl','TSLA','ZZZZZ','JPM','V','GOOG'])[(doc_id % 8) + 1],
          'entity_type': 'company', 'relevance_score': round((doc_id % 11) / 10.0, 6)}},
        {{'name': 'Person ' || (doc_id % 13), 'entity_type': 'person', 'relevance_score': 0.5}}
      ], 1, doc_id % 3)) as e from analyses)
    select article_event_id, e.name as name, e.entity_type as entity_type,
           cast(e.relevance_score as double) as relevance_score from pairs"""
)
def entity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = serve.entity_rows(B.analyses(spark, sf_dir))
    return rows.withColumn("relevance_score", F.round("relevance_score", 6))


@query(
    f"""with {NEWS}, {KEPT}, {ANALYSES}
    select {ANALYSIS_SQL} from analyses
    where article_event_id in (select event_id from kept)"""
)
def fk_valid_analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = references.valid_analyses(B.analyses(spark, sf_dir), kept_news(spark, sf_dir))
    return valid.select(*analysis_columns())


@query(
    f"""with {NEWS}, {KEPT}, {ANALYSES}
    select {ANALYSIS_SQL} from analyses
    where article_event_id not in (select event_id from kept)"""
)
def fk_orphan_analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    orphans = references.orphan_analyses(B.analyses(spark, sf_dir), kept_news(spark, sf_dir))
    return orphans.select(*analysis_columns())
