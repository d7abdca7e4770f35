"""Feed scans, normalisation and source-key de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart import bindings as B, schemas as S
from newsmart.catalog.registry import (
    EVENT_ID,
    KEPT,
    NEWS,
    SCORE,
    STAMP,
    TICKERS,
    URL,
    at,
    at_sql,
    derived_id_sql,
    listed,
    listed_sql,
    query,
)
from newsmart.functions.text import extract_terms
from newsmart.functions.times import compact_timestamp, entry_timestamp
from newsmart.operators.dedup import (
    dedup_content as first_per_content,
    dedup_entry,
    dedup_source_url,
    stream_dedup,
)
from newsmart.operators.enrich import with_content_hash
from newsmart.operators.normalize import (
    entry_link,
    filing_entries_to_raw,
    market_items_to_raw,
    union_sources as select_sources,
)
from newsmart.operators.validate import rejected
from newsmart.plans.news import raw_envelopes
from newsmart.session import scratch_path
from newsmart.sources import feeds
from newsmart.streaming import streams

# Ingest time of every query here: a parameter, so results repeat.
INGESTED = "2024-03-01 00:00:00"


def _ingested():
    return F.lit(INGESTED).cast("timestamp")


def _land_market(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "market")
    B.market_responses(spark, sf_dir).write.text(path)
    return path


def _market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded items of the market responses, read from a landing folder."""
    return feeds.market_items(feeds.market_responses(spark.read, _land_market(spark, sf_dir)))


def _market_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_items_to_raw(feeds.market_records(_market(spark, sf_dir)), _ingested())


def _land_filings(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "filings")
    entries = B.filing_entries(spark, sf_dir).drop("doc_id")
    entries.write.format("xml").options(rootTag="feed", rowTag="entry").save(path)
    return path


def _filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filing entries, read from a folder of Atom files."""
    return feeds.filing_entries(spark.read, _land_filings(spark, sf_dir))


def _filing_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filing_entries_to_raw(_filings(spark, sf_dir), _ingested(), B.WATCHLIST)


# Items that are accepted, with what they say.
_ITEMS = f"""items as (
  select doc_id, {URL} as url, substr(text, 1, 60) as title, text as summary, source,
         case doc_id % 10 when 5 then 'invalid-date'
              when 6 then strftime({STAMP}, '%Y%m%dT%H%M')
              else strftime({STAMP}, '%Y%m%dT%H%M%S') end as time_published,
         case when doc_id % 10 in (5, 6) then timestamp '{INGESTED}' else {STAMP} end as ts,
         case when doc_id % 2 = 0 then [source] else [] end as authors,
         cast({SCORE} as double) as score, {TICKERS} as tickers
  from documents where doc_id % 10 not in (0, 1, 2, 3, 4))"""

_MARKET_RAW = f"""market as (
  select {derived_id_sql("'alpha_vantage'", 'url')} as event_id, ts, 'alpha_vantage' as source,
         url as source_url, title, summary as content, tickers,
         '{{"overall_sentiment_score":' || cast(score as varchar)
         || ',"overall_sentiment_label":"Neutral","source_domain":"' || source
         || '","authors":[' || case when len(authors) > 0 then '"' || source || '"' else '' end
         || ']}}' as raw_metadata
  from items)"""

_ENTRIES = f"""entries as (
  select doc_id,
         case when doc_id % 8 <> 0 then '8-K - filing ' || doc_id end as title,
         case when doc_id % 8 <> 3 then 'https://filings.example.com/' || lang || '-' || n_chars end
           as link,
         case when doc_id % 8 not in (2, 3) then 'urn:filing:' || lang || '-' || n_chars end as id,
         case when doc_id % 8 <> 1 then trim(regexp_replace(text, '\\s+', ' ', 'g')) end as summary,
         case when doc_id % 8 = 5 then timestamp '{INGESTED}' else {STAMP} end as ts
  from documents)"""


def _words_sql(text: str) -> str:
    words = ", ".join(f"'{w}'" for w in B.WATCHLIST)
    tokens = f"string_split_regex(upper({text}), '[^\\p{{L}}\\p{{N}}_]+')"
    return f"list_filter([{words}], lambda w: list_contains({tokens}, w))"


_FILING_RAW = f"""filings as (
  select {derived_id_sql("'sec_edgar'", 'key')} as event_id, ts, 'sec_edgar' as source,
         source_url, title, content, {_words_sql("title || ' ' || content")} as tickers,
         '{{"filing_type":"8-K","entry_id":"' || entry_id || '"}}' as raw_metadata, key as entry_key
  from (select *, coalesce(nullif(entry_id, ''), source_url) as key from (
    select ts, coalesce(link, '') as source_url, coalesce(title, '{S.UNTITLED_FILING}') as title,
           coalesce(summary, '') as content, coalesce(id, '') as entry_id from entries)))"""

_RAW_SQL = f"""event_id, {at_sql('ts', 'timestamp')}, source, source_url, title, content,
  {listed_sql('tickers')}, raw_metadata"""


def _raw_columns() -> list:
    return [
        "event_id",
        at("timestamp"),
        "source",
        "source_url",
        "title",
        "content",
        listed("tickers"),
        "raw_metadata",
    ]


@query(
    f"""with {_ITEMS}
    select url, title, summary, source, time_published, {listed_sql('authors')},
           score as overall_sentiment_score, 'Neutral' as overall_sentiment_label,
           {listed_sql('tickers')}
    from items"""
)
def scan_market_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.market_records(_market(spark, sf_dir)).select(
        "url",
        "title",
        "summary",
        "source",
        "time_published",
        listed("authors"),
        "overall_sentiment_score",
        "overall_sentiment_label",
        F.array_join("ticker_sentiment.ticker", "|").alias("tickers"),
    )


@query(
    """with items as (
      select unnest(case doc_id % 10
        when 0 then ['missing:url'] when 3 then ['malformed']
        when 4 then ['number:overall_sentiment_score']
        when 7 then ['missing:url,missing:summary,missing:source,missing:time_published,'
                     || 'missing:overall_sentiment_score,missing:overall_sentiment_label']
        else [] end) as reason
      from documents)
    select reason, count(*) as item_count from items group by reason"""
)
def market_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = rejected(_market(spark, sf_dir))
    return dead.groupBy("reason").agg(F.count(F.lit(1)).alias("item_count"))


@query(f"with {_ITEMS}, {_MARKET_RAW} select {_RAW_SQL} from market")
def normalize_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _market_raw(spark, sf_dir).select(*_raw_columns())


@query(
    f"""select doc_id, published,
      strftime(case when doc_id % 10 in (5, 6) then timestamp '{INGESTED}' else {STAMP} end,
               '%Y-%m-%d %H:%M:%S') as "timestamp",
      doc_id % 10 in (5, 6) as fell_back
    from (select doc_id, case doc_id % 10 when 5 then 'invalid-date'
            when 6 then strftime({STAMP}, '%Y%m%dT%H%M')
            else strftime({STAMP}, '%Y%m%dT%H%M%S') end as published from documents)"""
)
def parse_compact_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = compact_timestamp(F.col("published"))
    return (
        B.table(spark, sf_dir, "documents")
        .select("doc_id", B.published_text().alias("published"))
        .withColumn("timestamp", F.coalesce(read, _ingested()))
        .select("doc_id", "published", at("timestamp"), read.isNull().alias("fell_back"))
    )


@query(
    f"""with {_ENTRIES}
    select title, link, id, summary, doc_id % 8 = 4 as only_published from entries"""
)
def scan_filing_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filings(spark, sf_dir).select(
        "title",
        entry_link(F.col("link")).alias("link"),
        "id",
        "summary",
        (F.col("updated").isNull() & F.col("published").isNotNull()).alias("only_published"),
    )


@query(f"with {_ENTRIES}, {_FILING_RAW} select {_RAW_SQL} from filings")
def normalize_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filing_raw(spark, sf_dir).select(*_raw_columns())


@query(
    f"""with {_ENTRIES}
    select doc_id, {at_sql('ts', 'timestamp')} from entries"""
)
def timestamp_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = B.filing_entries(spark, sf_dir)
    read = entry_timestamp(F.col("updated"), F.col("published"))
    stamped = entries.withColumn("timestamp", F.coalesce(read, _ingested()))
    return stamped.select("doc_id", at("timestamp"))


@query(
    f"""select {EVENT_ID} as event_id,
      array_to_string({_words_sql("substr(text, 1, 60) || ' ' || text")}, '|') as tickers
    from documents"""
)
def extract_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_terms(F.concat_ws(" ", "title", "content"), B.WATCHLIST)
    return B.news(spark, sf_dir).withColumn("tickers", found).select("event_id", listed("tickers"))


@query(
    f"""with {NEWS}
    select event_id, source_url, {at_sql('ts', 'timestamp')} from news
    qualify row_number() over (partition by source_url order by ts, event_id) = 1"""
)
def dedup_source_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_source_url(B.news(spark, sf_dir)).select("event_id", "source_url", at("timestamp"))


@query(
    f"""with {_ENTRIES}, {_FILING_RAW}
    select event_id, min(strftime(ts, '%Y-%m-%d %H:%M:%S')) as "timestamp" from filings
    group by event_id"""
)
def dedup_entry_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_entry(_filing_raw(spark, sf_dir)).select("event_id", at("timestamp"))


@query(
    f"""with {NEWS}, {KEPT}
    select event_id, content_hash, {at_sql('ts', 'timestamp')} from kept"""
)
def dedup_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = first_per_content(with_content_hash(B.news(spark, sf_dir)))
    return kept.select("event_id", "content_hash", at("timestamp"))


@query(
    f"""with {_ITEMS}, {_MARKET_RAW}, {_ENTRIES}, {_FILING_RAW}, sent as (
      select coalesce(tickers[1], 'QUERIED') as key, event_id from market
      union all select coalesce(tickers[1], '{S.NO_TICKER_FILING}'), event_id from filings)
    select '{S.RAW_TOPIC}' as topic, key, event_id from sent"""
)
def publish_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds as records of the raw topic, each with its own fallback key."""
    market = raw_envelopes(_market_raw(spark, sf_dir), "QUERIED")
    filings = raw_envelopes(_filing_raw(spark, sf_dir), S.NO_TICKER_FILING)
    sent = market.unionByName(filings)
    return sent.select("topic", "key", F.get_json_object("value", "$.event_id").alias("event_id"))


@query(
    f"""with {_ITEMS}, {_MARKET_RAW}, {_ENTRIES}, {_FILING_RAW}
    select distinct event_id, source, source_url from market
    union all
    select distinct event_id, source, null from filings"""
)
def stream_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feed folders followed, normalised, united and stored once per article."""
    out = scratch_path(spark, "feeds")
    responses = feeds.market_responses(spark.readStream, _land_market(spark, sf_dir))
    items = feeds.market_records(feeds.market_items(responses))
    entries = feeds.filing_entries(spark.readStream, _land_filings(spark, sf_dir))
    frames = {
        "alpha_vantage": market_items_to_raw(items, _ingested()),
        "sec_edgar": filing_entries_to_raw(entries, _ingested(), B.WATCHLIST),
    }
    united = select_sources(frames, "real").withColumn("arrived", F.current_timestamp())
    once = stream_dedup(united, "event_id", "1 hour", "arrived").drop("arrived")
    streams.to_folder(once, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    stored = spark.read.schema(S.RAW_NEWS).parquet(f"{out}/data")
    # Which of two readings survives is open, and with it whether it had a link.
    link = F.when(F.col("source") == "alpha_vantage", F.col("source_url"))
    return stored.select("event_id", "source", link.alias("source_url"))


@query(
    f"""with {NEWS}, {_ITEMS}, {_MARKET_RAW}, {_ENTRIES}, {_FILING_RAW}, unioned as (
      select event_id, ts, source, source_url, title, tickers, raw_metadata from market
      union all select event_id, ts, source, source_url, title, tickers, raw_metadata from filings
      union all select event_id, ts, source, source_url, title, tickers, raw_metadata from news
        where source = 'synthetic')
    select event_id, {at_sql('ts', 'timestamp')}, source, source_url, title,
           {listed_sql('tickers')} from unioned"""
)
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {
        "synthetic": B.news(spark, sf_dir).where("source = 'synthetic'"),
        "alpha_vantage": _market_raw(spark, sf_dir),
        "sec_edgar": _filing_raw(spark, sf_dir),
    }
    return select_sources(frames, "all").select(
        "event_id", at("timestamp"), "source", "source_url", "title", listed("tickers")
    )
