"""The streams, each run over what is there and then stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart import bindings as B, schemas as S
from newsmart.catalog.keywords import keyword_annotator
from newsmart.catalog.records import BEARISH, BULLISH
from newsmart.catalog.registry import KEPT, NEWS, at, at_sql, company, listed, listed_sql, query
from newsmart.catalog.storage import (
    LAKE,
    LAKE_SQL,
    STORED,
    lake_columns,
    land_topics,
    stored_records,
)
from newsmart.catalog.tickers import kept_news
from newsmart.operators.aggregate import snapshot_by_emit_interval, tumbling_counts
from newsmart.operators.dedup import stream_dedup as dedup_stream
from newsmart.operators.enrich import with_content_hash
from newsmart.operators.validate import PROCESSED_RULES, accepted, decode
from newsmart.plans import news as plans
from newsmart.session import scratch_path
from newsmart.sinks.tables import AGGREGATES, ANALYSES, ARTICLES
from newsmart.sinks.topics import land
from newsmart.sources.tables import read_lake, read_snapshot, read_table
from newsmart.sources.topics import landed_topics
from newsmart.streaming import streams


def _minute_later():
    return F.col("timestamp") + F.expr("interval 1 minute")


def _stream_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.as_news(B.stream_documents(spark, sf_dir))


@query(
    f"""with {NEWS}
    select event_id, {at_sql('ts', 'timestamp')}, source, title, {listed_sql('tickers')}
    from news"""
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw topic records followed from the start, checked, and stored once."""
    topic, out = scratch_path(spark, "raw"), scratch_path(spark, "ingest")
    news = B.news(spark, sf_dir)
    land(plans.raw_envelopes(news, S.NO_TICKER), topic)
    good, _ = plans.raw_records(landed_topics(spark, topic))
    streams.to_folder(good, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    stored = spark.read.schema(S.RAW_NEWS).parquet(f"{out}/data")
    return stored.select("event_id", at("timestamp"), "source", "title", listed("tickers"))


@query(f"with {NEWS} select distinct content_hash from news")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which copy survives on a stream is open, so only the contents compare."""
    out = scratch_path(spark, "dedup")
    hashed = with_content_hash(_stream_news(spark, sf_dir)).select(
        "event_id", "timestamp", "content_hash"
    )
    distinct = dedup_stream(hashed, "content_hash", "1 hour", "timestamp")
    streams.to_folder(distinct, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/data").select("content_hash")


@query(f"with {NEWS} select distinct content_hash, length(content) as n_chars from news")
def stream_process_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw news followed through hash, de-duplication and enrichment."""
    out = scratch_path(spark, "process")
    processed = plans.process_stream(_stream_news(spark, sf_dir), _minute_later())
    streams.to_folder(processed, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    stored = spark.read.schema(S.PROCESSED_NEWS).parquet(f"{out}/data")
    return stored.select("content_hash", F.length("content").alias("n_chars"))


@query(
    f"""with {NEWS}, spread as (select processed_at, unnest(tickers) as ticker from news),
    counted as (
      select ticker, to_timestamp(floor(epoch(processed_at) / 300) * 300 + 300) at time zone 'UTC'
               as window_end, min(processed_at) as window_start, count(*) as article_count
      from spread group by 1, 2)
    select ticker, {company('ticker')} as company_name, {at_sql('window_start')},
           {at_sql('window_end')}, article_count from counted"""
)
def stream_emit_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per ticker and emit interval, kept up by a stream."""
    out = scratch_path(spark, "emit")
    news = _stream_news(spark, sf_dir).withColumn("processed_at", _minute_later())
    counted = snapshot_by_emit_interval(news.withWatermark("processed_at", "10 minutes"))
    streams.to_snapshot(counted, f"{out}/data", f"{out}/checkpoint", None).awaitTermination()
    return read_snapshot(spark, f"{out}/data", counted.schema).select(
        "ticker", "company_name", at("window_start"), at("window_end"), "article_count"
    )


@query(
    f"""with {NEWS}, spread as (select ts, score, unnest(tickers) as ticker from news)
    select ticker, {company('ticker')} as company_name,
           {at_sql("date_trunc('hour', ts)", 'window_start')},
           count(*) as article_count, round(avg(score), 6) as avg_sentiment_score
    from spread group by ticker, date_trunc('hour', ts)"""
)
def stream_ticker_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "hourly")
    counted = tumbling_counts(_stream_news(spark, sf_dir).withWatermark("timestamp", "1 hour"))
    streams.to_snapshot(counted, f"{out}/data", f"{out}/checkpoint", None).awaitTermination()
    return read_snapshot(spark, f"{out}/data", counted.schema).select(
        "ticker",
        "company_name",
        at("window_start"),
        "article_count",
        F.round("avg_sentiment_score", 6).alias("avg_sentiment_score"),
    )


@query(
    f"""with {NEWS}, spread as (select ts, score, unnest(tickers) as ticker from news),
    windows as (
      select ticker, date_trunc('hour', ts) as window_start, date_trunc('hour', ts) + interval 1 hour as window_end,
             count(*) as article_count, round(avg(score), 6) as avg_sentiment_score
      from spread group by ticker, date_trunc('hour', ts))
    select ticker, {company('ticker')} as company_name, {at_sql('window_start')}, {at_sql('window_end')},
           article_count, avg_sentiment_score
    from windows where window_end <= (select max(ts) - interval 1 hour from news)"""
)
def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows emitted once, when the watermark has passed them, and forgotten; open ones are held back."""
    out = scratch_path(spark, "closed")
    counted = tumbling_counts(_stream_news(spark, sf_dir).withWatermark("timestamp", "1 hour"))
    streams.to_folder(counted, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(counted.schema).parquet(f"{out}/data").select(
        "ticker",
        "company_name",
        at("window_start"),
        at("window_end"),
        "article_count",
        F.round("avg_sentiment_score", 6).alias("avg_sentiment_score"),
    )


@query(
    f"""with {NEWS}, spread as (select ts, score, unnest(tickers) as ticker from news)
    select ticker, {at_sql("date_trunc('hour', ts)", 'window_start')},
           max(n) as article_count from (
      select *, count(*) over (partition by ticker, date_trunc('hour', ts)) as n from spread)
    group by ticker, date_trunc('hour', ts)"""
)
def stream_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window snapshots appended to the aggregate table; the last one counts."""
    out = scratch_path(spark, "aggregates")
    counted = tumbling_counts(_stream_news(spark, sf_dir).withWatermark("timestamp", "1 hour"))
    full = counted.withColumn("dominant_sentiment", F.lit(None).cast("string"))
    streams.to_aggregates(full, out, f"{out}/checkpoint", None).awaitTermination()
    stored = read_table(spark, f"{out}/{AGGREGATES}", S.TICKER_AGGREGATE)
    count = F.max("article_count").alias("article_count")
    last = stored.groupBy("ticker", "window_start").agg(count)
    return last.select("ticker", at("window_start"), "article_count")


@query(
    f"""with {NEWS}, {KEPT}
    select event_id as article_event_id, 'keywords' as model_id from kept"""
)
def stream_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed topic records followed through the model into the analyses."""
    topic, out = scratch_path(spark, "processed"), scratch_path(spark, "stream-annotate")
    land(plans.processed_envelopes(kept_news(spark, sf_dir)), topic)
    envelopes = landed_topics(spark, topic)
    streams.to_tables(envelopes, out, f"{out}/c1").awaitTermination()
    processed = accepted(decode(envelopes, PROCESSED_RULES), PROCESSED_RULES)
    model = keyword_annotator(BULLISH, BEARISH)
    streams.to_analyses(processed, out, f"{out}/c2", model, "keywords").awaitTermination()
    stored = read_table(spark, f"{out}/{ANALYSES}", S.ANALYSIS)
    return stored.select("article_event_id", "model_id")


@query(STORED)
def stream_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed topic records followed into the serving tables."""
    out = scratch_path(spark, "stream-tables")
    envelopes = landed_topics(spark, land_topics(spark, sf_dir))
    streams.to_tables(envelopes, f"{out}/serving", f"{out}/checkpoint").awaitTermination()
    return stored_records(spark, f"{out}/serving")


@query(f"with {LAKE} select {LAKE_SQL} from lake")
def stream_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed topic records followed into the lake."""
    topic, out = scratch_path(spark, "processed"), scratch_path(spark, "stream-lake")
    land(plans.processed_envelopes(kept_news(spark, sf_dir)), topic)
    processed = accepted(decode(landed_topics(spark, topic), PROCESSED_RULES), PROCESSED_RULES)
    streams.to_lake(
        processed, f"{out}/data", f"{out}/checkpoint", every=None, rows_per_file=0
    ).awaitTermination()
    return read_lake(spark, f"{out}/data").select(*lake_columns())


@query(
    f"""with {LAKE}
    select 'lake' as sink, count(*) as rows from lake
    union all select 'articles', count(*) from kept"""
)
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One processed topic into the tables and the lake, each at its own pace."""
    topic, out = scratch_path(spark, "processed"), scratch_path(spark, "fan-out")
    land(plans.processed_envelopes(kept_news(spark, sf_dir)), topic)
    envelopes = landed_topics(spark, topic)
    processed = accepted(decode(envelopes, PROCESSED_RULES), PROCESSED_RULES)
    running = streams.fan_out("all", processed, envelopes, out, f"{out}/checkpoints")
    for running_query in running.values():
        running_query.awaitTermination()
    filed = read_lake(spark, f"{out}/lake").agg(F.count(F.lit(1)).alias("rows"))
    stored = read_table(spark, f"{out}/serving/{ARTICLES}", S.PROCESSED_NEWS).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return filed.select(F.lit("lake").alias("sink"), "rows").unionByName(
        stored.select(F.lit("articles").alias("sink"), "rows")
    )
