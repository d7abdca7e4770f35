"""Ticker to company name."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsmart.schemas import COMPANIES


def _lookup() -> Column:
    # Folded by Catalyst into one literal map; 52 entries, fixed.
    return F.create_map(*map(F.lit, chain.from_iterable(COMPANIES.items())))


def company_name(ticker: Column) -> Column:
    """Company of the ticker whatever its case; an unknown ticker stays as given."""
    return F.coalesce(F.try_element_at(_lookup(), F.upper(ticker)), ticker)


def company_names(tickers: Column) -> Column:
    """Company of each ticker, order and duplicates kept."""
    return F.transform(tickers, company_name)


def company_dimension(spark: SparkSession) -> DataFrame:
    """The built-in lookup as a (ticker, company_name) table, 52 rows and fixed."""
    rows = spark.createDataFrame(list(COMPANIES.items()), "ticker string, company_name string")
    return F.broadcast(rows)
