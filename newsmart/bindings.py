"""The test tables read as the engine's records.

``documents`` stand for news, ``labels`` for analyses of them, ``events`` for a
ticker stream and ``pages`` for filings.  Every row of a table becomes a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from newsmart import schemas as S
from newsmart.functions.companies import company_names
from newsmart.functions.text import content_hash

# Known, unknown and lower-case tickers.
UNIVERSE = ("AAPL", "MSFT", "aapl", "TSLA", "ZZZZZ", "JPM", "V", "GOOG")
# Words that do occur in the documents, used as a watch list.
WATCHLIST = ("THE", "AND", "LES", "AAPL")

_MINUTE = 60_000_000
_START = 1_704_067_200_000_000  # 2024-01-01 00:00:00 UTC in microseconds
_ANALYZED = 1_706_745_600_000_000  # 2024-02-01 00:00:00 UTC

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A glob, since a stream's path may be one file or a folder of them.
    return spark.readStream.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parque[t]")


def event_id() -> Column:
    number = F.lpad(F.col("doc_id").cast("string"), 12, "0")
    return F.concat(F.lit("00000000-0000-0000-0000-"), number)


def timestamp() -> Column:
    return F.timestamp_micros(F.lit(_START) + F.col("doc_id") * F.lit(7 * _MINUTE))


def processed_at() -> Column:
    return F.col("timestamp") + F.expr("interval 1 minute")


def tickers() -> Column:
    universe = F.array(*map(F.lit, UNIVERSE))
    place = [(F.col("doc_id") * 7 + k * 3) % len(UNIVERSE) for k in range(3)]
    three = F.array(*[F.get(universe, p.cast("int")) for p in place])
    return F.slice(three, 1, (F.col("doc_id") % 4).cast("int"))


def source_url() -> Column:
    return F.concat(
        F.lit("https://news.example.com/"), F.col("lang"), F.lit("/"), F.col("n_chars")
    )


def score() -> Column:
    """-1.0 to 1.0 in tenths."""
    return ((F.col("doc_id") % 21 - 10) / F.lit(10)).cast("decimal(4,1)")


def as_news(documents: DataFrame) -> DataFrame:
    """Documents as raw news."""
    sources = F.array(*map(F.lit, S.SOURCES))
    metadata = F.concat(F.lit('{"overall_sentiment_score":'), score().cast("string"), F.lit("}"))
    return documents.select(
        event_id().alias("event_id"),
        timestamp().alias("timestamp"),
        F.get(sources, (F.col("doc_id") % 3).cast("int")).alias("source"),
        source_url().alias("source_url"),
        F.substring("text", 1, 60).alias("title"),
        F.col("text").alias("content"),
        tickers().alias("tickers"),
        F.when(F.col("doc_id") % 3 == 0, metadata).alias("raw_metadata"),
    )


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_news(table(spark, sf_dir, "documents"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News in processed form, before any de-duplication."""
    return news(spark, sf_dir).select(
        "*",
        company_names(F.col("tickers")).alias("companies"),
        content_hash(F.col("content")).alias("content_hash"),
        processed_at().alias("processed_at"),
    )


def analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as analyses; every fifth document is analysed again a day later."""
    label = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "bullish")
        .when((F.col("quality") == 0) & (F.col("toxic") == 1), "bearish")
        .when((F.col("quality") == 0) & (F.col("toxic") == 0), "neutral")
        .otherwise("mixed")
    )
    labels = table(spark, sf_dir, "labels").select("*", label.alias("label"))
    repeats = F.when(F.col("doc_id") % 5 == 0, F.sequence(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    runs = labels.select("*", F.explode(repeats).alias("run"))
    minutes = F.col("doc_id") * 3 + F.col("run") * 1440
    first = F.struct(
        F.get(F.array(*map(F.lit, UNIVERSE)), (F.col("doc_id") % 8).cast("int")).alias("name"),
        F.lit("company").alias("entity_type"),
        (F.col("doc_id") % 11 / F.lit(10.0)).alias("relevance_score"),
    )
    second = F.struct(
        F.concat(F.lit("Person "), F.col("doc_id") % 13).alias("name"),
        F.lit("person").alias("entity_type"),
        F.lit(0.5).alias("relevance_score"),
    )
    return runs.select(
        event_id().alias("article_event_id"),
        F.concat(F.lit("Summary of "), F.col("doc_id")).alias("summary"),
        F.when(F.col("run") == 1, "mixed").otherwise(F.col("label")).alias("sentiment"),
        ((F.col("doc_id") % 51 + 50) / F.lit(100.0)).alias("sentiment_confidence"),
        F.slice(F.array(first, second), 1, (F.col("doc_id") % 3).cast("int")).alias("entities"),
        F.array(F.col("label"), F.concat(F.lit("topic-"), F.col("doc_id") % 7)).alias("key_topics"),
        F.timestamp_micros(F.lit(_ANALYZED) + minutes * F.lit(_MINUTE)).alias("analyzed_at"),
        F.lit("model-a").alias("model_id"),
        F.when(F.col("run") == 1, "2.0").otherwise("1.0").alias("analysis_version"),
    )


def ticker_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as news that names one ticker, with its value as score."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.concat(
            F.lit("00000000-0000-0000-0001-"), F.lpad(F.col("event_id").cast("string"), 12, "0")
        ).alias("event_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.array("event_type").alias("tickers"),
        F.to_json(F.struct(F.col("value").alias("overall_sentiment_score"))).alias("raw_metadata"),
    )


# --- topic and feed text derived from the tables -----------------------------


def raw_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News as raw topic values; a part of them broken in a known way.

    By doc_id mod 20 -- 0: cut short, 1: no title, 2: unknown source,
    3: tickers not a list, 4: not an object, 5: a tombstone, 6: no event id,
    7: id not a UUID, 8: a null among the tickers, 9: metadata not an object,
    10: an unknown extra field.
    """
    kind = F.col("doc_id") % 20
    documents = table(spark, sf_dir, "documents")
    record = F.struct(
        F.when(kind == 7, F.lit("not-a-uuid"))
        .when(kind == 6, F.lit(None))
        .otherwise(event_id())
        .alias("event_id"),
        F.date_format(timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.when(kind == 2, "invalid_source").otherwise(F.col("_source")).alias("source"),
        source_url().alias("source_url"),
        F.when(kind != 1, F.substring("text", 1, 60)).alias("title"),
        F.col("text").alias("content"),
        F.when(kind == 8, F.array(F.lit("AAPL"), F.lit(None)))
        .otherwise(tickers())
        .alias("tickers"),
        F.when(kind == 10, F.lit("x")).alias("extra"),
    )
    source = F.get(F.array(*map(F.lit, S.SOURCES)), (F.col("doc_id") % 3).cast("int"))
    encoded = documents.withColumn("_source", source).select("doc_id", F.to_json(record).alias("v"))
    value = (
        F.when(kind == 0, F.expr("substring(v, 1, length(v) - 5)"))
        .when(kind == 3, F.regexp_replace("v", r'"tickers":\[[^\]]*\]', '"tickers":"AAPL"'))
        .when(kind == 4, F.lit("not valid json"))
        .when(kind == 5, F.lit(None))
        .when(kind == 9, F.regexp_replace("v", r"\}$", ',"raw_metadata":"text"}'))
        .otherwise(F.col("v"))
    )
    # Built once, as if read from a topic, whatever is asked of it afterwards.
    return encoded.select("doc_id", F.explode(F.array(value)).alias("value"))


def market_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One market response per document.

    By doc_id mod 10 -- 0: the item lacks a url, 1: no feed, 2: an empty feed,
    3: not JSON, 4: the score is text, 5: an unreadable time, 6: a time without
    seconds, 7: a second item that has only a title.
    """
    kind = F.col("doc_id") % 10
    mentions = F.transform(
        tickers(),
        lambda t: F.struct(
            t.alias("ticker"),
            F.lit("0.5").alias("relevance_score"),
            F.lit("0.1").alias("ticker_sentiment_score"),
            F.lit("Neutral").alias("ticker_sentiment_label"),
        ),
    )
    item = F.to_json(
        F.struct(
            F.substring("text", 1, 60).alias("title"),
            F.when(kind != 0, source_url()).alias("url"),
            F.col("text").alias("summary"),
            F.col("source").alias("source"),
            published_text().alias("time_published"),
            F.when(F.col("doc_id") % 2 == 0, F.array("source")).alias("authors"),
            score().cast("double").alias("overall_sentiment_score"),
            F.lit("Neutral").alias("overall_sentiment_label"),
            mentions.alias("ticker_sentiment"),
        )
    )
    text_score = F.regexp_replace(
        item, r'"overall_sentiment_score":[-0-9.]+', '"overall_sentiment_score":"high"'
    )
    feed = F.when(kind == 4, text_score).when(
        kind == 7, F.concat(item, F.lit(',{"title":"missing required fields"}'))
    ).otherwise(item)
    value = (
        F.when(kind == 1, F.lit('{"items":"0"}'))
        .when(kind == 2, F.lit('{"items":"0","feed":[]}'))
        .when(kind == 3, F.lit("rate limit reached"))
        .otherwise(F.concat(F.lit('{"items":"1","feed":['), feed, F.lit("]}")))
    )
    return table(spark, sf_dir, "documents").select(value.alias("value"))


def published_text() -> Column:
    """Compact publication time; some do not read (see ``market_responses``)."""
    kind = F.col("doc_id") % 10
    return (
        F.when(kind == 5, F.lit("invalid-date"))
        .when(kind == 6, F.date_format(timestamp(), "yyyyMMdd'T'HHmm"))
        .otherwise(F.date_format(timestamp(), "yyyyMMdd'T'HHmmss"))
    )


def filing_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as filing entries, some of them incomplete.

    By doc_id mod 8 -- 0: no title, 1: no summary, 2: no id, 3: neither id nor
    link, 4: only published, 5: no readable time, 6: RFC 822 time.  Documents
    of one language and length share an id, as an entry read twice would.
    """
    kind = F.col("doc_id") % 8
    east = timestamp() - F.expr("interval 5 hours")
    updated = (
        F.when(kind == 4, F.lit(None))
        .when(kind == 5, F.lit("yesterday"))
        .when(kind == 6, F.date_format(timestamp(), "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .otherwise(F.date_format(east, "yyyy-MM-dd'T'HH:mm:ss'-05:00'"))
    )
    name = F.concat_ws("-", "lang", "n_chars")
    link = F.struct(F.concat(F.lit("https://filings.example.com/"), name).alias("_href"))
    zulu = F.date_format(timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(kind != 0, F.concat(F.lit("8-K - filing "), F.col("doc_id"))).alias("title"),
        F.when(kind != 3, link).alias("link"),
        F.when(~kind.isin(2, 3), F.concat(F.lit("urn:filing:"), name)).alias("id"),
        updated.alias("updated"),
        F.when(kind == 4, zulu).alias("published"),
        F.when(kind != 1, F.trim(F.regexp_replace("text", r"\s+", " "))).alias("summary"),
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as raw model replies, some fenced and some wrong.

    By doc_id mod 12 -- 0: fenced as json, 1: fenced, 2: padded, 3: no summary,
    4: unknown label, 5: confidence 1.5, 6: confidence quoted, 7: no entities
    and topics, 8: not JSON, 9: confidence not a number, 10: the call failed,
    11: an entity without a type.
    """
    kind = F.col("doc_id") % 12
    entity = F.struct(
        F.lit("Apple Inc.").alias("name"),
        F.when(kind != 11, "company").alias("entity_type"),
        F.lit(0.95).alias("relevance_score"),
    )
    label = F.get(F.array(*map(F.lit, S.SENTIMENTS)), (F.col("doc_id") % 4).cast("int"))
    confidence = (F.col("doc_id") % 101) / F.lit(100.0)
    body = F.to_json(
        F.struct(
            F.when(kind != 3, F.concat(F.lit("Summary of "), F.col("doc_id"))).alias("summary"),
            F.when(kind == 4, "super_bullish").otherwise(label).alias("sentiment"),
            F.when(kind == 5, F.lit(1.5)).otherwise(confidence).alias("sentiment_confidence"),
            F.when(kind != 7, F.array(entity)).alias("entities"),
            F.when(kind != 7, F.array(F.lit("earnings"), F.lit("revenue"))).alias("key_topics"),
        )
    )
    number = r'"sentiment_confidence":([0-9.]+)'
    text = (
        F.when(kind == 0, F.concat(F.lit("Here it is:\n```json\n"), body, F.lit("\n```\nDone.")))
        .when(kind == 1, F.concat(F.lit("```\n"), body, F.lit("```")))
        .when(kind == 2, F.concat(F.lit("\n\t "), body, F.lit(" \n")))
        .when(kind == 6, F.regexp_replace(body, number, '"sentiment_confidence":"$1"'))
        .when(kind == 8, F.lit("I cannot analyse this article."))
        .when(kind == 9, F.regexp_replace(body, number, '"sentiment_confidence":"high"'))
        .when(kind == 10, F.lit(None))
        .otherwise(body)
    )
    return table(spark, sf_dir, "labels").select(
        event_id().alias("article_event_id"),
        text.alias("reply"),
        F.when(kind == 10, F.lit("no_reply")).alias("error"),
    )
