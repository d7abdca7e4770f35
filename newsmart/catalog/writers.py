"""Several writers of one table, and runs after a failure."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart import bindings as B, schemas as S
from newsmart.catalog.keywords import keyword_annotator
from newsmart.catalog.records import BEARISH, BULLISH
from newsmart.catalog.registry import ANALYSES, KEPT, NEWS, query
from newsmart.catalog.tickers import kept_news
from newsmart.operators.validate import PROCESSED_RULES, accepted, decode
from newsmart.plans import news as plans
from newsmart.session import scratch_path
from newsmart.sinks import tables
from newsmart.sinks.topics import land
from newsmart.sources.tables import read_table
from newsmart.sources.topics import landed_topics
from newsmart.streaming import streams


def _articles_after(spark: SparkSession, sf_dir: str, halves: bool, checkpoints: int) -> DataFrame:
    """Stored articles after one or two sources and a number of checkpoints each."""
    out = scratch_path(spark, "writers")
    news = kept_news(spark, sf_dir)
    half = F.pmod(F.xxhash64("event_id"), F.lit(2)) if halves else F.lit(0)
    for part in range(2 if halves else 1):
        topic = f"{out}/topic-{part}"
        land(plans.processed_envelopes(news.where(half == part)), topic)
        for run in range(checkpoints):
            envelopes = landed_topics(spark, topic)
            streams.to_tables(envelopes, f"{out}/tables", f"{out}/c-{part}-{run}").awaitTermination()
    stored = read_table(spark, f"{out}/tables/{tables.ARTICLES}", S.PROCESSED_NEWS)
    return stored.select("event_id", "content_hash")


_STORED = f"with {NEWS}, {KEPT} select event_id, content_hash from kept"


@query(_STORED)
def stream_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams store their articles in one table."""
    return _articles_after(spark, sf_dir, halves=True, checkpoints=1)


@query(_STORED)
def stream_fresh_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream started again without its checkpoint stores nothing twice."""
    return _articles_after(spark, sf_dir, halves=False, checkpoints=2)


@query(
    f"""with {NEWS}, {KEPT}
    select event_id as article_event_id, model_id from kept, (values ('a'), ('b')) m(model_id)"""
)
def stream_two_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models annotate one topic into one table; the first starts again afresh."""
    topic, out = scratch_path(spark, "processed"), scratch_path(spark, "two-models")
    land(plans.processed_envelopes(kept_news(spark, sf_dir)), topic)
    envelopes = landed_topics(spark, topic)
    streams.to_tables(envelopes, out, f"{out}/c").awaitTermination()
    processed = accepted(decode(envelopes, PROCESSED_RULES), PROCESSED_RULES)
    for model, checkpoint in [("a", "a1"), ("b", "b1"), ("a", "a2")]:
        make = keyword_annotator(BULLISH, BEARISH)
        streams.to_analyses(processed, out, f"{out}/{checkpoint}", make, model).awaitTermination()
    stored = read_table(spark, f"{out}/{tables.ANALYSES}", S.ANALYSIS)
    return stored.select("article_event_id", "model_id")


@query(f"with {NEWS}, {KEPT} select distinct content_hash from kept")
def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw topic to processed topic to tables, each a stream of its own."""
    out = scratch_path(spark, "publish")
    land(plans.raw_envelopes(B.news(spark, sf_dir), S.NO_TICKER), f"{out}/raw")
    good, _ = plans.raw_records(landed_topics(spark, f"{out}/raw"))
    processed = plans.process_stream(good, F.current_timestamp())
    envelopes = plans.processed_envelopes(processed)
    streams.to_folder(envelopes, f"{out}/processed", f"{out}/c1").awaitTermination()
    streams.to_tables(
        landed_topics(spark, f"{out}/processed"), f"{out}/tables", f"{out}/c2"
    ).awaitTermination()
    stored = read_table(spark, f"{out}/tables/{tables.ARTICLES}", S.PROCESSED_NEWS)
    return stored.select("content_hash")


def _every_fifth_fails():
    """A model that is down for every fifth article, by its text."""
    complete = keyword_annotator(BULLISH, BEARISH)()

    def ask(prompts: pd.Series) -> list:
        answers = list(complete(prompts))
        return [None if len(p) % 5 == 0 else a for p, a in zip(prompts, answers, strict=True)]

    return ask


@query(
    f"""with {NEWS}
    select event_id as article_event_id,
           case when length('Title: ' || title || chr(10) || chr(10) || 'Content: '
                     || substr(content, 1, {S.PROMPT_CONTENT_CHARS})) % 5 = 0 then 2 else 1 end as run
    from news"""
)
def annotate_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run that answered each article: failures of the first are sent again, no others."""
    replies = scratch_path(spark, "replies")
    articles = B.articles(spark, sf_dir)
    for run, make in enumerate([_every_fifth_fails, keyword_annotator(BULLISH, BEARISH)], 1):
        day = F.lit(f"2024-01-0{run} 00:00:00").cast("timestamp")
        found, _ = plans.annotate_articles(articles, replies, make, "m", day)
    return found.select("article_event_id", F.dayofmonth("analyzed_at").alias("run"))


def _without_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    analyses = B.analyses(spark, sf_dir)
    plain = F.to_json(
        F.struct(*[c for c in S.ANALYSIS.fieldNames() if c != "analysis_version"]),
        {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"},
    )
    return analyses.where("analysis_version = '1.0'").select(
        F.lit(S.ANALYSIS_TOPIC).alias("topic"), F.lit(None).cast("string").alias("key"), plain.alias("value")
    )


def _late_articles(spark: SparkSession, sf_dir: str, retries: int) -> DataFrame:
    """Analyses first, then their articles, then so many retries."""
    root = scratch_path(spark, "late")
    tables.write_topics(_without_version(spark, sf_dir), root, "analyses")
    tables.write_topics(plans.processed_envelopes(kept_news(spark, sf_dir)), root, "articles")
    for run in range(retries):
        tables.retry_orphans(spark, root, f"retry-{run}")
    stored = read_table(spark, f"{root}/{tables.ANALYSES}", S.ANALYSIS)
    return stored.select("article_event_id", "model_id", "analysis_version", "sentiment")


_LATE = f"""with {NEWS}, {KEPT}, {ANALYSES}
    select article_event_id, model_id, analysis_version, sentiment from analyses
    where analysis_version = '1.0' and article_event_id in (select event_id from kept)"""


@query(_LATE)
def topic_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analyses without a version are stored under the record's default."""
    return _late_articles(spark, sf_dir, retries=1)


@query(_LATE)
def retry_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrying again stores nothing twice."""
    return _late_articles(spark, sf_dir, retries=3)


@query(
    """select doc_id from documents where doc_id % 20 in (0, 1, 2, 3, 4, 7, 8, 9)"""
)
def stream_raw_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves of the raw topic followed into folders; the records set aside."""
    out = scratch_path(spark, "raw-dead")
    B.raw_values(spark, sf_dir).write.parquet(f"{out}/raw")
    followed = spark.readStream.schema(spark.read.parquet(f"{out}/raw").schema).parquet(f"{out}/raw")
    good, dead = plans.raw_records(followed)
    streams.to_folder(good, f"{out}/good", f"{out}/c1").awaitTermination()
    streams.to_folder(dead, f"{out}/dead", f"{out}/c2").awaitTermination()
    return spark.read.parquet(f"{out}/dead").select("doc_id")
