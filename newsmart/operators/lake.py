"""The lake's shape: projection, partition columns and partition counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsmart.schemas import LAKE_COLUMNS, NO_TICKER


def event_date(timestamp: Column) -> Column:
    """UTC date of the event, ``yyyy-MM-dd``."""
    return F.date_format(timestamp, "yyyy-MM-dd")


def partition_tickers() -> Column:
    """The tickers an article is filed under; articles without one share a name."""
    return F.when(F.size("tickers") > 0, F.col("tickers")).otherwise(F.array(F.lit(NO_TICKER)))


def lake_rows(processed: DataFrame) -> DataFrame:
    """One row per article and ticker occurrence, with its ``date`` and ``ticker``."""
    stored = [
        F.coalesce("source_url", F.lit("")).alias("source_url") if c == "source_url" else F.col(c)
        for c in LAKE_COLUMNS
    ]
    return processed.select(
        *stored,
        event_date(F.col("timestamp")).alias("date"),
        F.explode(partition_tickers()).alias("ticker"),
    )


def partition_counts(processed: DataFrame) -> DataFrame:
    """Rows per lake partition, before anything is written."""
    return lake_rows(processed).groupBy("date", "ticker").agg(
        F.count(F.lit(1)).alias("row_count")
    )
