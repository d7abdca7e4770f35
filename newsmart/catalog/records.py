"""Validation, record functions, wire format and annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart import bindings as B, schemas as S
from newsmart.catalog.keywords import keyword_annotator
from newsmart.catalog.registry import (
    ARTICLE_SQL,
    COMPANIES_OF,
    EVENT_ID,
    KEPT,
    NEWS,
    article_columns,
    at,
    at_sql,
    derived_id_sql,
    listed,
    listed_sql,
    query,
)
from newsmart.functions import companies, identity, text
from newsmart.functions.wire import encode
from newsmart.operators import annotate, enrich
from newsmart.operators.references import valid_analyses
from newsmart.operators.validate import PROCESSED_RULES, RAW_RULES, accepted, decode
from newsmart.plans import news as plans
from newsmart.session import scratch_path

ANALYZED_AT = "2024-03-01 00:00:00"


def _processed_at():
    return F.col("timestamp") + F.expr("interval 1 minute")


_STAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S')"

# Good raw values (see the binding), with the id each ends up with.
_VALID = f"""valid as (
  select doc_id, ts, source, source_url, title, content, tickers, content_hash,
         ts + interval 1 minute as processed_at,
         case when doc_id % 20 = 6 then
           {derived_id_sql('source', 'source_url', _STAMP, 'title', 'content')}
         else event_id end as event_id
  from news where doc_id % 20 not in (0, 1, 2, 3, 4, 5, 7, 8, 9))"""


@query(
    f"""with {NEWS}, {_VALID}
    select event_id, {at_sql('ts', 'timestamp')}, source, source_url, title, content,
           {listed_sql('tickers')} from valid"""
)
def validate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = plans.raw_records(B.raw_values(spark, sf_dir))
    return good.select(
        "event_id", at("timestamp"), "source", "source_url", "title", "content", listed("tickers")
    )


_REASONS = """case doc_id % 20 when 0 then 'malformed' when 1 then 'missing:title'
  when 2 then 'domain:source' when 3 then 'malformed' when 4 then 'malformed'
  when 7 then 'uuid:event_id' when 8 then 'element:tickers' when 9 then 'object:raw_metadata' end"""


@query(
    f"""select doc_id, {_REASONS} as reason from documents
    where doc_id % 20 in (0, 1, 2, 3, 4, 7, 8, 9)"""
)
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dead = plans.raw_records(B.raw_values(spark, sf_dir))
    return dead.select("doc_id", "reason")


@query(
    f"""select '{S.DEAD_LETTER_TOPIC}' as topic, {_REASONS} as key, count(*) as record_count
    from documents where doc_id % 20 in (0, 1, 2, 3, 4, 7, 8, 9) group by all"""
)
def dead_letter_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dead = plans.raw_records(B.raw_values(spark, sf_dir))
    counted = plans.dead_letter_envelopes(dead).groupBy("topic", "key")
    return counted.agg(F.count("value").alias("record_count"))


@query(
    """select count(*) as tombstones, count(distinct doc_id) as rows_seen from documents
    where doc_id % 20 = 5"""
)
def drop_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = B.raw_values(spark, sf_dir)
    seen = decode(values, RAW_RULES).select("doc_id")
    dropped = values.select("doc_id").join(seen, "doc_id", "left_anti")
    return dropped.agg(
        F.count(F.lit(1)).alias("tombstones"), F.countDistinct("doc_id").alias("rows_seen")
    )


@query("select doc_id, sha256(text) as content_hash from documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = B.table(spark, sf_dir, "documents")
    return documents.select("doc_id", text.content_hash(F.col("text")).alias("content_hash"))


@query(
    f"""with {NEWS}
    select event_id, {listed_sql('tickers')}, array_to_string({COMPANIES_OF}, '|') as companies
    from news"""
)
def enrich_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = B.news(spark, sf_dir).withColumn("companies", companies.company_names(F.col("tickers")))
    return named.select("event_id", listed("tickers"), listed("companies"))


@query(
    f"""with {NEWS}
    select event_id, array_to_string({COMPANIES_OF}, '|') as companies from news"""
)
def enrich_from_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = companies.company_dimension(spark)
    named = enrich.enrich_from_dimension(B.news(spark, sf_dir), dimension)
    return named.select("event_id", listed("companies"))


@query(
    f"""with {NEWS}
    select event_id, coalesce(tickers[1], 'UNKNOWN') as processed_key,
           coalesce(tickers[1], 'SEC-8K') as filing_key from news"""
)
def routing_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickers = F.col("tickers")
    return B.news(spark, sf_dir).select(
        "event_id",
        text.routing_key(tickers, S.NO_TICKER).alias("processed_key"),
        text.routing_key(tickers, S.NO_TICKER_FILING).alias("filing_key"),
    )


@query(
    f"""with {NEWS}
    select {ARTICLE_SQL}, content_hash, round(score, 6) as score from news"""
)
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = B.articles(spark, sf_dir).select(encode(S.PROCESSED_NEWS).alias("value"))
    back = accepted(decode(values, PROCESSED_RULES), PROCESSED_RULES)
    score = F.get_json_object("raw_metadata", "$.overall_sentiment_score").cast("double")
    return back.select(*article_columns(), "content_hash", F.round(score, 6).alias("score"))


@query(
    f"""with {NEWS}
    select event_id as given, {derived_id_sql("'sec_edgar'", 'source_url')} as derived from news"""
)
def assign_event_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = identity.derived_event_id(F.lit("sec_edgar"), F.col("source_url"))
    braced = F.concat(F.lit("{"), F.upper("event_id"), F.lit("}"))
    return B.news(spark, sf_dir).select(
        identity.canonical_uuid(braced).alias("given"),
        derived.alias("derived"),
    )


@query(
    f"""with {NEWS}
    select event_id, 'Title: ' || title || chr(10) || chr(10) || 'Content: '
           || substr(content, 1, {S.PROMPT_CONTENT_CHARS}) as prompt from news"""
)
def render_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = text.render_prompt(F.col("title"), F.col("content"))
    return B.news(spark, sf_dir).select("event_id", prompt.alias("prompt"))


# Replies as the binding makes them, and what they amount to.
_REPLIES = f"""replies as (
  select doc_id, doc_id % 12 as kind, {EVENT_ID} as article_event_id,
         (['bullish', 'bearish', 'neutral', 'mixed'])[(doc_id % 4) + 1] as sentiment,
         (doc_id % 101) / 100.0 as confidence
  from labels)"""


@query(
    f"""with {_REPLIES}
    select article_event_id, kind <> 8 as is_object, kind <> 3 and kind <> 8 as has_summary
    from replies where kind <> 10"""
)
def unfence_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = B.replies(spark, sf_dir).where("reply is not null").select(
        "article_event_id", text.unfence_json(F.col("reply")).alias("body")
    )
    return bare.select(
        "article_event_id",
        (F.col("body").startswith("{") & F.col("body").endswith("}")).alias("is_object"),
        F.get_json_object("body", "$.summary").isNotNull().alias("has_summary"),
    )


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.replies(spark, sf_dir).select(
        "*",
        F.lit(ANALYZED_AT).cast("timestamp").alias("analyzed_at"),
        F.lit("model-a").alias("model_id"),
        F.lit(S.ANALYSIS_VERSION).alias("analysis_version"),
    )


@query(
    f"""with {_REPLIES}
    select article_event_id, 'Summary of ' || doc_id as summary, sentiment,
           cast(confidence as double) as sentiment_confidence,
           case when kind = 7 then '' else 'Apple Inc.' end as entities,
           case when kind = 7 then '' else 'earnings|revenue' end as key_topics,
           '{ANALYZED_AT}' as analyzed_at, 'model-a' as model_id, '1.0' as analysis_version
    from replies where kind not in (3, 4, 5, 8, 9, 10, 11)"""
)
def parse_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = annotate.parse_replies(_replies(spark, sf_dir))
    return good.select(
        "article_event_id",
        "summary",
        "sentiment",
        "sentiment_confidence",
        F.array_join("entities.name", "|").alias("entities"),
        listed("key_topics"),
        at("analyzed_at"),
        "model_id",
        "analysis_version",
    )


@query(
    f"""with {_REPLIES}
    select article_event_id, case kind when 3 then 'missing:summary' when 4 then 'domain:sentiment'
           when 5 then 'range:sentiment_confidence' when 8 then 'malformed'
           when 9 then 'number:sentiment_confidence' when 10 then 'no_reply'
           else 'element:entities' end as reason
    from replies where kind in (3, 4, 5, 8, 9, 10, 11)"""
)
def analysis_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dead = annotate.parse_replies(_replies(spark, sf_dir))
    return dead.select("article_event_id", "reason")


# Words of the documents that stand for good and bad news.
BULLISH, BEARISH = ("the", "les", "und"), ("and", "der", "que")


def _count_sql(words: tuple[str, ...]) -> str:
    edge = "[^\\p{L}\\p{N}_]+"
    listed_words = ", ".join(f"'{w}'" for w in words)
    return (
        f"len(list_filter(string_split_regex(lower(prompt), '{edge}'),"
        f" lambda w: list_contains([{listed_words}], w)))"
    )


@query(
    f"""with {NEWS}, {KEPT}, prompts as (
      select event_id, title, 'Title: ' || title || chr(10) || chr(10) || 'Content: '
             || substr(content, 1, {S.PROMPT_CONTENT_CHARS}) as prompt from kept),
    votes as (select event_id, {_count_sql(BULLISH)} as up, {_count_sql(BEARISH)} as down
              from prompts)
    select event_id as article_event_id,
           case when up + down = 0 then 'neutral' when up = down then 'mixed'
                when up > down then 'bullish' else 'bearish' end as sentiment,
           round(case when up + down = 0 then 1.0
                      else cast(greatest(up, down) as double) / (up + down) end, 6)
             as sentiment_confidence,
           'keywords' as model_id
    from votes"""
)
def annotate_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All news annotated; analyses of articles that were not kept are dropped."""
    analyses, _ = plans.annotate_articles(
        B.articles(spark, sf_dir),
        scratch_path(spark, "replies"),
        keyword_annotator(BULLISH, BEARISH),
        "keywords",
        F.lit(ANALYZED_AT).cast("timestamp"),
        partitions=spark.sparkContext.defaultParallelism,
    )
    stored = plans.process_news(B.news(spark, sf_dir), _processed_at())
    return valid_analyses(analyses, stored).select(
        "article_event_id",
        "sentiment",
        F.round("sentiment_confidence", 6).alias("sentiment_confidence"),
        "model_id",
    )


@query(
    f"""with {NEWS}, {_VALID}, first_valid as (
      select * from valid
      qualify row_number() over (partition by content_hash order by ts, event_id) = 1)
    select {ARTICLE_SQL}, content_hash from first_valid"""
)
def process_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = plans.raw_records(B.raw_values(spark, sf_dir))
    processed = plans.process_news(good, _processed_at())
    return processed.select(*article_columns(), "content_hash")
