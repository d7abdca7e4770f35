"""The query surface: pages, latest rows, look-ups and response projections.

Every ordering ends in a unique column, so equal timestamps page the same way
each time.  ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: each task
keeps its own top rows and only those are sent on.

A page is found on its sort columns first.  The time of its last row then goes
to the scan as a pushed-down filter, so the wide columns are read from the row
groups of that time span and not from the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newsmart import schemas as S
from newsmart.operators.dedup import first_per_key


def _check(name: str, value: int, low: int, high: int | None = None) -> None:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name}={value} is out of range")


def _mentions(ticker: str | None) -> Column:
    return F.array_contains("tickers", ticker) if ticker else F.lit(True)


def _newest() -> list[Column]:
    return [F.desc("timestamp"), F.asc("event_id")]


def _page(
    found: DataFrame,
    columns: Sequence[str],
    order: list[Column],
    time: str,
    limit: int,
    offset: int = 0,
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of a newest-first order on ``time``."""
    narrow = found.orderBy(*order).limit(offset + limit)
    oldest = narrow.agg(F.min(time)).scalar()
    recent = found.where(F.col(time) >= oldest).select(*columns)
    return recent.orderBy(*order).offset(offset).limit(limit)


def articles_page(
    articles: DataFrame, ticker: str | None = None, limit: int = 10, offset: int = 0
) -> DataFrame:
    """A page of articles, newest first, optionally those that name a ticker."""
    _check("limit", limit, 1, 100)
    _check("offset", offset, 0)
    found = articles.where(_mentions(ticker))
    return _page(found, S.ARTICLE_VIEW, _newest(), "timestamp", limit, offset)


#: Relative error of the sketch of times that finds a deep page, as one over this.
_ACCURACY = 10_000


def articles_page_after(
    articles: DataFrame, timestamp: object, event_id: str, ticker: str | None = None, limit: int = 10
) -> DataFrame:
    """The page that follows an article, newest first: its time and id are the cursor.

    However deep the page lies, each task keeps ``limit`` rows, and what is newer than
    the cursor is not read.
    """
    _check("limit", limit, 1, 100)
    at = F.lit(timestamp).cast("timestamp")
    later = (F.col("timestamp") < at) | ((F.col("timestamp") == at) & (F.col("event_id") > event_id))
    found = articles.where(_mentions(ticker)).where((F.col("timestamp") <= at) & later)
    return _page(found, S.ARTICLE_VIEW, _newest(), "timestamp", limit)


def _span(found: DataFrame, offset: int, limit: int) -> tuple[Column, int]:
    """A condition on the time that holds for a page's rows, and how many newer rows it leaves out.

    A sketch of the times gives two times around the page and an exact count of what
    lies beyond each confirms them; one that is not confirmed is not used.
    """
    micros = F.unix_micros("timestamp")
    n = found.count()
    slack = 2 * n // _ACCURACY + 1
    ranks = (offset - slack, offset + limit + slack)
    shares = [min(max(1 - r / n, 0.0), 1.0) if n else 0.0 for r in ranks]
    bounds = found.agg(F.percentile_approx(micros, F.array(*map(F.lit, shares)), _ACCURACY).alias("t")).first()["t"]
    if bounds is None:
        return F.lit(True), 0
    newest, oldest = (F.timestamp_micros(F.lit(t)) for t in bounds)
    beyond = found.agg(
        F.count_if(F.col("timestamp") > newest).alias("newer"), F.count_if(F.col("timestamp") >= oldest).alias("reached")
    ).first()
    inside, newer = F.lit(True), 0
    if ranks[0] > 0 and beyond["newer"] <= offset:
        inside, newer = F.col("timestamp").isNull() | (F.col("timestamp") <= newest), beyond["newer"]
    if ranks[1] < n and beyond["reached"] >= offset + limit:
        inside = inside & (F.col("timestamp") >= oldest)
    return inside, newer


def articles_deep_page(
    articles: DataFrame, ticker: str | None = None, limit: int = 10, offset: int = 0
) -> DataFrame:
    """``articles_page`` for large offsets: only the span of time that the page lies in is ordered."""
    _check("limit", limit, 1, 100)
    _check("offset", offset, 0)
    found = articles.where(_mentions(ticker))
    inside, newer = _span(found, offset, limit)
    page = found.where(inside).select(*S.ARTICLE_VIEW).orderBy(*_newest())
    return page.offset(offset - newer).limit(limit)


def latest_for_ticker(articles: DataFrame, ticker: str, limit: int = 5) -> DataFrame:
    """The newest articles that name the ticker."""
    _check("limit", limit, 1, 50)
    found = articles.where(F.array_contains("tickers", ticker))
    return _page(found, S.ARTICLE_VIEW, _newest(), "timestamp", limit)


def latest_per_ticker(articles: DataFrame, k: int = 5) -> DataFrame:
    """The newest ``k`` articles of every ticker in one job."""
    _check("k", k, 1, 50)
    # Ranked without the text, which is fetched for the winners alone.
    named = articles.select(
        "event_id", "timestamp", F.explode(F.array_distinct("tickers")).alias("ticker")
    )
    newest = first_per_key(named, ["ticker"], _newest(), k).drop("timestamp")
    return articles.select(*S.ARTICLE_VIEW).join(newest, "event_id").select(*S.ARTICLE_VIEW, "ticker")


def articles_by_ticker(articles: DataFrame, ticker: str | None) -> DataFrame:
    """All articles that name the ticker; an empty ticker filters nothing."""
    return articles.where(_mentions(ticker)).select(*S.ARTICLE_VIEW)


def articles_by_ids(articles: DataFrame, ids: Sequence[str] | DataFrame) -> DataFrame:
    """Articles with the given event ids.

    A list is pushed to the scan as ``IN``; a frame with ``event_id``, the form for
    many ids, is a semi join that Spark broadcasts only if it is small.
    """
    if not isinstance(ids, DataFrame):
        return articles.where(F.col("event_id").isin(list(ids))).select(*S.ARTICLE_VIEW)
    return articles.join(ids.select("event_id"), "event_id", "left_semi").select(*S.ARTICLE_VIEW)


def latest_analysis(analyses: DataFrame) -> DataFrame:
    """The newest analysis of each article."""
    order = [F.desc("analyzed_at"), F.asc("model_id"), F.asc("analysis_version")]
    return first_per_key(analyses, ["article_event_id"], order)


def article_analysis(
    articles: DataFrame, analyses: DataFrame, event_id: str | None = None
) -> DataFrame:
    """The analysis of each stored article, or of one.

    Analyses are reduced to one per article before the join, so the join is one
    to one.
    """
    if event_id is not None:
        articles = articles.where(F.col("event_id") == event_id)
        analyses = analyses.where(F.col("article_event_id") == event_id)
    ids = articles.select(F.col("event_id").alias("article_event_id"))
    return latest_analysis(analyses).join(ids, "article_event_id", "left_semi").select(
        *S.ANALYSIS.fieldNames()
    )


def aggregations_page(
    aggregates: DataFrame, ticker: str | None = None, limit: int = 10
) -> DataFrame:
    """Ticker aggregates, latest window first, optionally of one ticker."""
    _check("limit", limit, 1, 100)
    found = aggregates.where(F.col("ticker") == ticker) if ticker else aggregates
    order = [F.desc("window_end"), F.asc("ticker"), F.asc("window_start")]
    return found.select(*S.TICKER_AGGREGATE.fieldNames()).orderBy(*order).limit(limit)


def recent_analyses(analyses: DataFrame, limit: int = 10) -> DataFrame:
    """The newest analyses."""
    _check("limit", limit, 1)
    order = [F.desc("analyzed_at"), F.asc("article_event_id"), F.asc("model_id"), F.asc("analysis_version")]
    return _page(analyses, S.ANALYSIS.fieldNames(), order, "analyzed_at", limit)


def entity_rows(analyses: DataFrame) -> DataFrame:
    """One row per extracted entity."""
    return analyses.select("article_event_id", F.inline("entities"))
