"""Every operator as a query over the test tables."""

from newsmart.catalog import feeds, history, records, serving, storage, streams, tickers, timed, writers
from newsmart.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "feeds", "history", "records", "serving", "storage", "streams", "tickers", "timed", "writers"]
