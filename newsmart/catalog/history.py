"""Tables with a history: key indexes, chains of competing rows, de-duplication that leaves text in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart import bindings as B, schemas as S
from newsmart.catalog.registry import (
    ANALYSES,
    ANALYSIS_SQL,
    ARTICLE_SQL,
    KEPT,
    NEWS,
    analysis_columns,
    article_columns,
    at,
    at_sql,
    query,
)
from newsmart.functions.text import content_hash
from newsmart.operators.dedup import first_in_place
from newsmart.operators.references import insert_ignore
from newsmart.plans import news as plans
from newsmart.session import scratch_path
from newsmart.sinks import tables
from newsmart.sources.tables import read_table

#: Batches that the news are stored in, one after the other.
PARTS = 4

_HISTORY = f"""{NEWS}, kept as (
  select * from news
  qualify row_number() over (partition by content_hash order by doc_id % {PARTS}, ts, event_id) = 1)"""


def _with_history(spark: SparkSession, sf_dir: str) -> str:
    """All news in several batches whose indexes are merged half way, then all of them once more."""
    root = scratch_path(spark, "history")
    news = B.articles(spark, sf_dir)
    part = F.right("event_id", F.lit(12)).cast("long") % PARTS
    for n in range(PARTS):
        tables.write_articles(news.where(part == n), root, f"part-{n}")
        if n == PARTS // 2:
            tables.merge_indexes(spark, root)
    tables.write_articles(news, root, "again")
    return root


@query(f"with {_HISTORY} select event_id, content_hash, {at_sql('ts', 'timestamp')}, title, content from kept")
def insert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What batches store that look keys up in the index of those before them."""
    stored = read_table(spark, f"{_with_history(spark, sf_dir)}/{tables.ARTICLES}", S.PROCESSED_NEWS)
    return stored.select("event_id", "content_hash", at("timestamp"), "title", "content")


@query(
    f"""with {_HISTORY}, {ANALYSES}
    select {ANALYSIS_SQL} from analyses where article_event_id in (select event_id from kept)"""
)
def analyses_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analyses stored twice over an indexed history of articles and of analyses."""
    root = _with_history(spark, sf_dir)
    analyses = B.analyses(spark, sf_dir)
    tables.write_analyses(analyses.where("analysis_version = '1.0'"), root, "first")
    tables.write_analyses(analyses, root, "second")
    tables.merge_indexes(spark, root)
    tables.write_analyses(analyses, root, "third")
    return read_table(spark, f"{root}/{tables.ANALYSES}", S.ANALYSIS).select(*analysis_columns())


_CHAIN = f"""{NEWS}, rivals as (
  select event_id, content_hash, ts from news
  union all
  select a.event_id, b.content_hash, a.ts + interval 3 minute
  from news a join news b on b.doc_id = a.doc_id + 1),
single as (select event_id, content_hash, min(ts) as ts from rivals group by all),
numbered as (
  select *, row_number() over (order by ts, event_id, content_hash) as i,
         dense_rank() over (order by content_hash) as c, dense_rank() over (order by event_id) as e
  from single),
walk as (
  select cast(0 as bigint) as i, cast([] as bigint[]) as cs, cast([] as bigint[]) as es
  union all
  select n.i,
    case when list_contains(w.cs, n.c) or list_contains(w.es, n.e) then w.cs else list_append(w.cs, n.c) end,
    case when list_contains(w.cs, n.c) or list_contains(w.es, n.e) then w.es else list_append(w.es, n.e) end
  from walk w join numbered n on n.i = w.i + 1),
outcome as (
  select n.*, list_contains(before.cs, n.c) as copied, list_contains(before.es, n.e) as clashes
  from numbered n join walk before on before.i = n.i - 1)"""


@query(
    f"""with recursive {_CHAIN}
    select event_id, content_hash, {at_sql('ts', 'timestamp')},
           case when clashes then 'clash' else 'stored' end as outcome
    from outcome where not copied"""
)
def insert_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every article followed by the next one's text under its own id: each row waits for the one before."""
    news = B.articles(spark, sf_dir)
    number = F.right("event_id", F.lit(12)).cast("long")
    following = news.select((number - 1).alias("_number"), F.col("content").alias("_content"))
    rivals = (
        news.withColumn("_number", number)
        .join(following, "_number")
        .withColumn("content", F.col("_content"))
        .withColumn("content_hash", content_hash(F.col("content")))
        .withColumn("timestamp", F.col("timestamp") + F.expr("interval 3 minutes"))
    )
    batch = news.unionByName(rivals.select(*news.columns))
    inserts, clashes = insert_ignore(batch, news.limit(0).select("content_hash", "event_id"))
    columns = ["event_id", "content_hash", at("timestamp")]
    return inserts.select(*columns, F.lit("stored").alias("outcome")).unionByName(
        clashes.select(*columns, F.lit("clash").alias("outcome"))
    )


@query(f"with {NEWS}, {KEPT} select {ARTICLE_SQL}, content_hash from kept")
def process_news_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw news as processed news, only repeated articles moved."""
    processed = plans.process_news(B.news(spark, sf_dir), B.processed_at(), in_place=True)
    return processed.select(*article_columns(), "content_hash")


@query(
    f"""with {NEWS}
    select event_id, source_url, {at_sql('ts', 'timestamp')}, title, content from news
    qualify row_number() over (partition by source_url order by ts, event_id) = 1"""
)
def dedup_source_key_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = first_in_place(B.news(spark, sf_dir), F.coalesce("source_url", "event_id"), ["timestamp", "event_id"])
    return kept.select("event_id", "source_url", at("timestamp"), "title", "content")
