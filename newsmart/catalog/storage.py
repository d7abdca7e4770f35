"""The lake, the serving tables and the topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart import bindings as B, schemas as S
from newsmart.catalog.registry import (
    ANALYSES,
    ARTICLE_SQL,
    COMPANIES_OF,
    KEPT,
    NEWS,
    at,
    at_sql,
    listed,
    listed_sql,
    query,
)
from newsmart.catalog.tickers import SNAPSHOTS, kept_news, snapshots
from newsmart.functions.text import content_hash
from newsmart.operators import lake
from newsmart.operators.validate import PROCESSED_RULES, accepted, decode
from newsmart.plans import news as plans
from newsmart.session import scratch_path
from newsmart.sinks import tables
from newsmart.sinks.lake import write_lake
from newsmart.sinks.topics import land
from newsmart.sources.tables import read_lake, read_table
from newsmart.sources.topics import landed_topics

LAKE = f"""{NEWS}, {KEPT}, lake as (
  select *, strftime(ts, '%Y-%m-%d') as "date",
         unnest(case when len(tickers) = 0 then ['UNKNOWN'] else tickers end) as ticker
  from kept)"""

LAKE_SQL = f"""{ARTICLE_SQL}, content_hash, "date", ticker"""


def lake_columns() -> list:
    return [
        "event_id",
        at("timestamp"),
        "source",
        "source_url",
        "title",
        "content",
        listed("tickers"),
        listed("companies"),
        at("processed_at"),
        "content_hash",
        F.col("date").cast("string").alias("date"),
        "ticker",
    ]


@query(f"with {LAKE} select {LAKE_SQL} from lake")
def lake_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.lake_rows(kept_news(spark, sf_dir)).select(*lake_columns())


@query(
    f"""with {LAKE}
    select event_id, "date", ticker from lake"""
)
def partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.lake_rows(kept_news(spark, sf_dir)).select("event_id", "date", "ticker")


@query(
    f"""with {LAKE}
    select "date", ticker, count(*) as row_count from lake group by all"""
)
def lake_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.partition_counts(kept_news(spark, sf_dir))


def _lake(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "lake")
    write_lake(kept_news(spark, sf_dir), path)
    return path


@query(f"with {LAKE} select {LAKE_SQL} from lake")
def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lake(spark, _lake(spark, sf_dir)).select(*lake_columns())


@query(f"with {LAKE} select {LAKE_SQL} from lake where ticker = 'AAPL'")
def lake_scan_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lake(spark, _lake(spark, sf_dir), ticker="AAPL").select(*lake_columns())


@query(
    f"""with {NEWS}, {KEPT}
    select '{S.PROCESSED_TOPIC}' as topic, coalesce(tickers[1], 'UNKNOWN') as key,
           event_id, content, {listed_sql('tickers')},
           array_to_string({COMPANIES_OF}, '|') as companies, {at_sql('processed_at')}
    from kept"""
)
def publish_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = plans.processed_envelopes(kept_news(spark, sf_dir))
    parsed = sent.select(
        "topic", "key", F.explode(F.array(F.from_json("value", S.PROCESSED_NEWS))).alias("v")
    )
    return parsed.select("topic", "key", "v.*").select(
        "topic",
        "key",
        "event_id",
        "content",
        listed("tickers"),
        listed("companies"),
        at("processed_at"),
    )


# Labelled documents come again with corrected text under the same id.
_CORRECTED = """corrected as (
  select event_id, ts + interval 1 second as ts, sha256(content || ' (corrected)') as content_hash
  from news where doc_id in (select doc_id from labels)),
allowed as (
  select * from corrected where event_id not in (select event_id from kept)
  qualify row_number() over (partition by content_hash order by ts, event_id) = 1)"""


def _corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = B.table(spark, sf_dir, "labels").select(B.event_id().alias("event_id"))
    labelled = B.articles(spark, sf_dir).join(labels, "event_id", "left_semi")
    return (
        labelled.withColumn("content", F.concat("content", F.lit(" (corrected)")))
        .withColumn("content_hash", content_hash(F.col("content")))
        .withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 second"))
    )


def _stored_twice(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """All news stored, then all of it again together with corrections."""
    root = scratch_path(spark, "serving")
    news = B.articles(spark, sf_dir)
    tables.write_articles(news, root, "first")
    again = news.unionByName(_corrections(spark, sf_dir))
    return root, tables.write_articles(again, root, "second")


@query(
    f"""with {NEWS}, {KEPT}, {_CORRECTED}
    select event_id, content_hash, {at_sql('ts', 'timestamp')} from kept
    union all
    select event_id, content_hash, {at_sql('ts', 'timestamp')} from allowed"""
)
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _stored_twice(spark, sf_dir)
    stored = read_table(spark, f"{root}/{tables.ARTICLES}", S.PROCESSED_NEWS)
    return stored.select("event_id", "content_hash", at("timestamp"))


@query(
    f"""with {NEWS}, {KEPT}, {_CORRECTED}
    select c.event_id, c.content_hash, 'event_id_taken' as reason
    from corrected c left join allowed a on a.content_hash = c.content_hash
    where c.event_id in (select event_id from kept)
      and (a.content_hash is null or (c.ts, c.event_id) < (a.ts, a.event_id))"""
)
def insert_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, clashes = _stored_twice(spark, sf_dir)
    return clashes.select(
        F.get_json_object("value", "$.event_id").alias("event_id"),
        F.get_json_object("value", "$.content_hash").alias("content_hash"),
        "reason",
    )


def land_topics(spark: SparkSession, sf_dir: str) -> str:
    """Processed news, aggregates and analyses as one folder of topic records."""
    path = scratch_path(spark, "topics")
    land(plans.processed_envelopes(kept_news(spark, sf_dir)), path)
    land(plans.aggregate_envelopes(snapshots(spark, sf_dir)), path)
    land(plans.analysis_envelopes(B.analyses(spark, sf_dir)), path)
    return path


def stored_records(spark: SparkSession, root: str) -> DataFrame:
    """What the serving tables and the dead letters hold, one line per record."""
    articles = read_table(spark, f"{root}/{tables.ARTICLES}", S.PROCESSED_NEWS).select(
        F.lit("articles").alias("table"),
        F.col("event_id").alias("id"),
        F.col("content_hash").alias("detail"),
    )
    aggregates = read_table(spark, f"{root}/{tables.AGGREGATES}", S.TICKER_AGGREGATE).select(
        F.lit("ticker_aggregations").alias("table"),
        F.concat_ws(" ", "ticker", at("window_start")).alias("id"),
        F.col("article_count").cast("string").alias("detail"),
    )
    analyses = read_table(spark, f"{root}/{tables.ANALYSES}", S.ANALYSIS).select(
        F.lit("llm_analyses").alias("table"),
        F.col("article_event_id").alias("id"),
        F.concat_ws(" ", "sentiment", "analysis_version").alias("detail"),
    )
    dead = read_table(spark, f"{root}/{tables.DEAD}", S.DEAD_LETTER).select(
        F.lit("dead_letters").alias("table"),
        F.get_json_object("value", "$.article_event_id").alias("id"),
        F.col("reason").alias("detail"),
    )
    return articles.unionByName(aggregates).unionByName(analyses).unionByName(dead)


STORED = f"""with {SNAPSHOTS}
    select 'articles' as "table", event_id as id, content_hash as detail from kept
    union all
    select 'ticker_aggregations', ticker || ' ' || strftime(window_start, '%Y-%m-%d %H:%M:%S'),
           cast(article_count as varchar) from snapshots
    union all
    select 'llm_analyses', article_event_id, sentiment || ' ' || analysis_version from analyses
    where article_event_id in (select event_id from kept)
    union all
    select 'dead_letters', article_event_id, 'no_such_article' from analyses
    where article_event_id not in (select event_id from kept)"""


@query(STORED)
def topic_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "serving")
    envelopes = landed_topics(spark, land_topics(spark, sf_dir), streaming=False)
    tables.write_topics(envelopes, root, "all")
    return stored_records(spark, root)


@query(
    f"""with {NEWS}, {KEPT}
    select event_id, content_hash, {at_sql('ts', 'timestamp')} from kept"""
)
def topic_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed topic records read back and checked."""
    path = scratch_path(spark, "processed")
    land(plans.processed_envelopes(kept_news(spark, sf_dir)), path)
    decoded = decode(landed_topics(spark, path, streaming=False), PROCESSED_RULES)
    return accepted(decoded, PROCESSED_RULES).select("event_id", "content_hash", at("timestamp"))
