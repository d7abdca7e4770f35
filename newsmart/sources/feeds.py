"""Feeds that land as files: market responses (JSON) and filings (Atom).

Pass ``spark.readStream`` instead of ``spark.read`` to follow a folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, functions as F, types as T
from pyspark.sql.streaming import DataStreamReader

from newsmart import schemas as S
from newsmart.operators.validate import MARKET_ITEM_RULES, accepted, decode

Reader = DataFrameReader | DataStreamReader


def market_responses(reader: Reader, path: str, whole_files: bool = False) -> DataFrame:
    """Market responses as (value), one per line or, if asked, one per file."""
    return reader.format("text").option("wholetext", whole_files).load(path)


def market_items(responses: DataFrame) -> DataFrame:
    """Decoded feed items, good and bad; see ``validate.accepted`` / ``rejected``.

    A response without a feed has no items.  One that does not read, or whose feed
    is null, is passed on whole, so that it is set aside and not lost.
    """
    flagged = T.StructType([*S.MARKET_RESPONSE.fields, T.StructField("_corrupt", T.StringType())])
    response = F.from_json("value", flagged, {"columnNameOfCorruptRecord": "_corrupt"})
    read = responses.where("value is not null").select(
        "value", F.explode(F.array(response)).alias("response")
    )
    feed = F.try_variant_get(F.try_parse_json("value"), "$.feed", "variant")
    unread = F.col("response._corrupt").isNotNull() | F.coalesce(
        F.is_variant_null(feed), F.lit(False)
    )
    empty = F.array().cast("array<string>")
    items = F.when(unread, F.array("value")).otherwise(F.coalesce("response.feed", empty))
    return decode(read.select(F.explode(items).alias("value")), MARKET_ITEM_RULES)


def market_records(decoded: DataFrame) -> DataFrame:
    """The accepted items, missing lists as empty ones and the score as a number."""
    return accepted(decoded, MARKET_ITEM_RULES).withColumns(
        {
            "authors": F.coalesce("authors", F.array()),
            "ticker_sentiment": F.coalesce("ticker_sentiment", F.array()),
            "overall_sentiment_score": F.col("overall_sentiment_score").cast("double"),
        }
    )


def filing_entries(reader: Reader, path: str) -> DataFrame:
    """Entries of Atom filing feeds."""
    return (
        reader.format("xml").schema(S.FILING_ENTRY).option("rowTag", "entry").load(path)
    )
