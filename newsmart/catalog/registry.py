"""Registry of queries over the test tables, each with its check in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsmart import bindings as B
from newsmart.schemas import COMPANIES
from newsmart.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(run: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        QUERIES[run.__name__] = configured
        if oracle is not None:
            ORACLES[run.__name__] = oracle
        return run

    return register


# --- output columns that read the same from both engines ---------------------


def at(column: str) -> Column:
    """A timestamp column as text."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def listed(column: str) -> Column:
    """A list of strings as one text."""
    return F.array_join(column, "|").alias(column)


def article_columns() -> list[str | Column]:
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
    ]


# --- the bindings in SQL ------------------------------------------------------


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


UNIVERSE = "([" + ", ".join(map(_text, B.UNIVERSE)) + "])"

DIM = "dim(symbol, company) as (values " + ", ".join(
    f"({_text(k)}, {_text(v)})" for k, v in COMPANIES.items()
) + ")"

_LOOKUP = "map {" + ", ".join(f"{_text(k)}: {_text(v)}" for k, v in COMPANIES.items()) + "}"


def company(ticker: str) -> str:
    return f"coalesce(({_LOOKUP})[upper({ticker})], {ticker})"


def at_sql(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') as \"{name or column.split('.')[-1]}\""


def listed_sql(column: str) -> str:
    return f"array_to_string({column}, '|') as {column.split('.')[-1]}"


EVENT_ID = "'00000000-0000-0000-0000-' || lpad(cast(doc_id as varchar), 12, '0')"
STAMP = "timestamp '2024-01-01' + to_minutes(doc_id * 7)"
TICKERS = (
    f"list_transform(range(doc_id % 4), lambda k: {UNIVERSE}[((doc_id * 7 + k * 3) % 8) + 1])"
)
URL = "'https://news.example.com/' || lang || '/' || n_chars"
SOURCE = "(['alpha_vantage', 'sec_edgar', 'synthetic'])[(doc_id % 3) + 1]"
SCORE = "cast((doc_id % 21 - 10) / 10.0 as decimal(4,1))"

NEWS = f"""news as (
  select doc_id, {EVENT_ID} as event_id, {STAMP} as ts, {SOURCE} as source,
         {URL} as source_url, substr(text, 1, 60) as title, text as content,
         {TICKERS} as tickers,
         case when doc_id % 3 = 0 then
           '{{"overall_sentiment_score":' || cast({SCORE} as varchar) || '}}' end as raw_metadata,
         case when doc_id % 3 = 0 then cast({SCORE} as double) end as score,
         sha256(text) as content_hash, {STAMP} + interval 1 minute as processed_at
  from documents)"""

# Earliest row per content.
KEPT = """kept as (
  select * from news
  qualify row_number() over (partition by content_hash order by ts, event_id) = 1)"""

COMPANIES_OF = f"list_transform(tickers, lambda t: {company('t')})"

ANALYSES = f"""labelled as (
  select *, case when quality = 1 and toxic = 0 then 'bullish'
                 when quality = 0 and toxic = 1 then 'bearish'
                 when quality = 0 and toxic = 0 then 'neutral' else 'mixed' end as label
  from labels),
analyses as (
  select doc_id, {EVENT_ID} as article_event_id, 'Summary of ' || doc_id as summary,
         case when run = 1 then 'mixed' else label end as sentiment,
         (doc_id % 51 + 50) / 100.0 as sentiment_confidence,
         label, 'topic-' || (doc_id % 7) as topic,
         timestamp '2024-02-01' + to_minutes(doc_id * 3 + run * 1440) as analyzed_at,
         'model-a' as model_id, case when run = 1 then '2.0' else '1.0' end as analysis_version
  from labelled, (values (0), (1)) runs(run)
  where run = 0 or doc_id % 5 = 0)"""

ANALYSIS_SQL = f"""article_event_id, summary, sentiment,
  cast(sentiment_confidence as double) as sentiment_confidence,
  label || '|' || topic as key_topics, {at_sql('analyzed_at')}, model_id, analysis_version"""


def analysis_columns() -> list[str | Column]:
    return [
        "article_event_id",
        "summary",
        "sentiment",
        "sentiment_confidence",
        listed("key_topics"),
        at("analyzed_at"),
        "model_id",
        "analysis_version",
    ]


ARTICLE_SQL = f"""event_id, {at_sql('ts', 'timestamp')}, source, source_url, title, content,
  {listed_sql('tickers')}, array_to_string({COMPANIES_OF}, '|') as companies,
  {at_sql('processed_at')}"""


def derived_id_sql(*parts: str) -> str:
    text = " || chr(31) || ".join(parts)
    return (
        f"regexp_replace(sha256({text}), '^(.{{8}})(.{{4}}).(.{{3}}).(.{{3}})(.{{12}}).*$',"
        " '\\1-\\2-8\\3-8\\4-\\5')"
    )
