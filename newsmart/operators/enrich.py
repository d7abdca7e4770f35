"""Company enrichment and the raw-to-processed projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsmart.functions.companies import company_names
from newsmart.functions.text import content_hash
from newsmart.schemas import PROCESSED_NEWS


def with_content_hash(raw: DataFrame) -> DataFrame:
    return raw.withColumn("content_hash", content_hash(F.col("content")))


def to_processed(hashed: DataFrame, processed_at: Column) -> DataFrame:
    """Hashed raw news as processed news."""
    return (
        hashed.withColumn("companies", company_names(F.col("tickers")))
        .withColumn("processed_at", processed_at)
        .select(*PROCESSED_NEWS.fieldNames())
    )


def join_company(df: DataFrame, dimension: DataFrame, ticker: str = "ticker") -> DataFrame:
    """Add ``company_name`` by a left join on the upper-cased ticker.

    The dimension may be of any size: no hint is given, so Spark broadcasts it
    only while its measured size is under the session's threshold.  The join
    carries a skewed ticker because AQE splits its partition.
    """
    dim = dimension.select(
        F.col("ticker").alias("_dim_ticker"), F.col("company_name").alias("_dim_name")
    )
    joined = df.join(dim, F.upper(ticker) == F.col("_dim_ticker"), "left")
    return joined.withColumn("company_name", F.coalesce("_dim_name", ticker)).drop(
        "_dim_ticker", "_dim_name"
    )


def enrich_from_dimension(news: DataFrame, dimension: DataFrame) -> DataFrame:
    """Company arrays from a dimension too large for a literal map.

    Only (event_id, position, ticker) goes through the lookup; an array is put
    back together from its own elements, so no group is larger than one
    article's ticker list.  Ids must be unique.
    """
    slots = news.select("event_id", F.posexplode("tickers").alias("_pos", "ticker"))
    named = join_company(slots, dimension)
    pairs = F.array_sort(F.collect_list(F.struct("_pos", "company_name")))
    arrays = named.groupBy("event_id").agg(
        F.transform(pairs, lambda p: p["company_name"]).alias("_companies")
    )
    empty = F.array().cast("array<string>")
    return (
        news.join(arrays, "event_id", "left")
        .withColumn("companies", F.coalesce("_companies", empty))
        .drop("_companies")
    )
