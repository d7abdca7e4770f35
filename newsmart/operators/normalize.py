"""Feeds to the raw-news relation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from newsmart import schemas as S
from newsmart.functions.identity import derived_event_id
from newsmart.functions.text import extract_terms
from newsmart.functions.times import compact_timestamp, entry_timestamp


def market_items_to_raw(items: DataFrame, ingested_at: Column) -> DataFrame:
    """Market-feed items as raw news.

    ``ingested_at`` stands in where the published time does not read.
    """
    metadata = F.to_json(
        F.struct(
            "overall_sentiment_score",
            "overall_sentiment_label",
            F.col("source").alias("source_domain"),
            F.coalesce("authors", F.array().cast("array<string>")).alias("authors"),
        )
    )
    mentioned = F.coalesce("ticker_sentiment", F.array())
    return items.select(
        derived_event_id(F.lit("alpha_vantage"), F.col("url")).alias("event_id"),
        F.coalesce(compact_timestamp(F.col("time_published")), ingested_at).alias("timestamp"),
        F.lit("alpha_vantage").alias("source"),
        F.col("url").alias("source_url"),
        "title",
        F.col("summary").alias("content"),
        F.transform(mentioned, lambda m: m["ticker"]).alias("tickers"),
        metadata.alias("raw_metadata"),
    )


def entry_link(links: Column) -> Column:
    """Address of the entry's page: the last link that leads to an HTML alternate."""
    pages = F.filter(
        links,
        lambda k: (F.coalesce(k["_rel"], F.lit("alternate")) == "alternate")
        & F.coalesce(k["_type"], F.lit("text/html")).isin("text/html", "application/xhtml+xml"),
    )
    return F.try_element_at(pages, F.lit(-1))["_href"]


def entry_key(entry_id: Column, link: Column) -> Column:
    """What identifies a filing entry: its id, else its link, else nothing."""
    return F.coalesce(F.when(entry_id != "", entry_id), link, F.lit(""))


def filing_entries_to_raw(
    entries: DataFrame,
    ingested_at: Column,
    watchlist: Sequence[str] = S.DEFAULT_WATCHLIST,
) -> DataFrame:
    """Filing-feed entries as raw news, tagged with the watch-list terms they name.

    Adds ``entry_key`` for de-duplication.
    """
    title = F.coalesce("title", F.lit(S.UNTITLED_FILING))
    summary = F.coalesce("summary", F.lit(""))
    link = F.coalesce(entry_link(F.col("link")), F.lit(""))
    entry_id = F.coalesce("id", F.lit(""))
    key = entry_key(entry_id, link)
    metadata = F.to_json(
        F.struct(F.lit(S.FILING_TYPE).alias("filing_type"), entry_id.alias("entry_id"))
    )
    return entries.select(
        derived_event_id(F.lit("sec_edgar"), key).alias("event_id"),
        F.coalesce(entry_timestamp(F.col("updated"), F.col("published")), ingested_at).alias(
            "timestamp"
        ),
        F.lit("sec_edgar").alias("source"),
        link.alias("source_url"),
        title.alias("title"),
        summary.alias("content"),
        extract_terms(F.concat_ws(" ", title, summary), watchlist).alias("tickers"),
        metadata.alias("raw_metadata"),
        key.alias("entry_key"),
    )


# Which normalised feeds a selection reads.
_SELECTIONS = {
    "fake": ("synthetic",),
    "alpha_vantage": ("alpha_vantage",),
    "sec_edgar": ("sec_edgar",),
    "real": ("alpha_vantage", "sec_edgar"),
    "all": ("synthetic", "alpha_vantage", "sec_edgar"),
}


def union_sources(feeds: dict[str, DataFrame], selection: str) -> DataFrame:
    """The selected feeds as one raw-news relation; ``feeds`` maps source to frame."""
    names = _SELECTIONS.get(selection.lower())
    if names is None:
        raise ValueError(f"unknown source selection: {selection}")
    absent = [n for n in names if n not in feeds]
    if absent:
        raise ValueError(f"selection {selection} needs feeds {absent}")
    chosen = [feeds[n].select(*S.RAW_NEWS.fieldNames()) for n in names]
    return reduce(DataFrame.unionByName, chosen)
