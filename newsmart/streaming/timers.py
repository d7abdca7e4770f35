"""Streams that act when time has passed: snapshots at each tick, buffers flushed by count or age.

State lives in the query's state store, per ticker or per writer, and timers run on
processing time, so both survive a restart: what was counted or buffered before it is
emitted after it, once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from newsmart import schemas as S
from newsmart.functions.companies import company_name
from newsmart.functions.times import WIRE_TIMESTAMP
from newsmart.operators.aggregate import by_ticker, sentiment_score
from newsmart.streaming.streams import EMIT_INTERVAL, LAKE_FLUSH, LAKE_ROWS_PER_FILE, to_lake

SIZE, AGE, STOP = "size", "age", "stop"


def seconds(interval: str) -> float:
    """Length of an interval such as ``300 seconds``."""
    return pd.Timedelta(interval).total_seconds()


# --- counts from the first arrival to the next tick ------------------------------------

_WINDOW = "opened timestamp, articles long, scored long, score double"
_CLOSED = "ticker string, window_start timestamp, window_end timestamp, article_count long, avg_sentiment_score double"


def _stamp(milliseconds: int) -> pd.Timestamp:
    return pd.Timestamp(milliseconds, unit="ms", tz="UTC")


class _TickerWindow(StatefulProcessor):
    """One open window per ticker: it opens at the first article after a tick and closes at the next tick."""

    def __init__(self, every: float) -> None:
        self.every = int(every * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", _WINDOW)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        held = self.window.get()
        opened, articles, scored, score = held or (_stamp(now).to_pydatetime(), 0, 0, 0.0)
        for batch in rows:
            articles += int(batch["articles"].sum())
            scored += int(batch["scored"].sum())
            score += float(batch["score"].sum())
        if held is None:
            self.handle.registerTimer((now // self.every + 1) * self.every)
        self.window.update((opened, articles, scored, score))
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        opened, articles, scored, score = self.window.get()
        self.window.clear()
        closed = _stamp(expiredTimerInfo.getExpiryTimeInMs())
        mean = score / scored if scored else None
        yield pd.DataFrame(
            {
                "ticker": [key[0]], "window_start": [pd.Timestamp(opened)], "window_end": [closed],
                "article_count": [articles], "avg_sentiment_score": pd.array([mean], "Float64"),
            }
        )

    def close(self) -> None:
        pass


def _partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts per ticker of each Arrow batch, so that a hot ticker is a row per batch in the shuffle."""
    for batch in batches:
        grouped = batch.groupby("ticker")["score"]
        yield pd.DataFrame({"articles": grouped.size(), "scored": grouped.count(), "score": grouped.sum()}).reset_index()


def tick_snapshots(news: DataFrame, every: str = EMIT_INTERVAL) -> DataFrame:
    """Counts and mean score per ticker from its first article after a tick to the next tick, on a stream.

    A window is emitted once, at its tick, and forgotten; a ticker without articles has none.
    """
    score = sentiment_score(F.col("raw_metadata")).alias("score")
    partial = by_ticker(news, score).mapInPandas(_partial, "ticker string, articles long, scored long, score double")
    closed = partial.groupBy("ticker").transformWithStateInPandas(
        _TickerWindow(seconds(every)), _CLOSED, "Append", "ProcessingTime"
    )
    return closed.select(
        "ticker",
        company_name(F.col("ticker")).alias("company_name"),
        "window_start",
        "window_end",
        "article_count",
        "avg_sentiment_score",
        F.lit(None).cast("string").alias("dominant_sentiment"),
    )


# --- buffers flushed by count or age ----------------------------------------------------

_FLUSH = "slot long, flush long, reason string, record string"
#: Records wait as JSON, like in a topic.
_WIRE = {"timestampFormat": WIRE_TIMESTAMP}


class _Buffer(StatefulProcessor):
    """One buffer per writer slot: a list of records, how many there are, and how often it was flushed.

    ``size`` records are flushed at once, the rest when the oldest is ``age`` old, and
    what is left when a row without a record asks the slot to stop.
    """

    def __init__(self, size: int, age: float) -> None:
        self.size, self.age = size, int(age * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.records = handle.getListState("records", "record string")
        self.counts = handle.getValueState("counts", "held long, flushes long, due long")

    @staticmethod
    def _frame(slot: int, flush: int, reason: str, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({"slot": slot, "flush": flush, "reason": reason, "record": [r[0] for r in rows]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        held, flushes, due = self.counts.get() or (0, 0, 0)
        fresh: list[tuple] = []  # what no flush has taken: never more than a flush and a batch
        stop = flushed = False
        for batch in rows:
            stop = stop or bool(batch["stop"].any())
            fresh += [(record,) for record in batch.loc[~batch["stop"], "record"]]
            if held + len(fresh) < self.size:
                continue
            if held:
                fresh, held = list(self.records.get()) + fresh, 0
            at, flushed = 0, True
            while len(fresh) - at >= self.size:
                yield self._frame(key[0], flushes, SIZE, fresh[at : at + self.size])
                at, flushes = at + self.size, flushes + 1
            fresh = fresh[at:]
        if stop and held + len(fresh):
            yield self._frame(key[0], flushes, STOP, (list(self.records.get()) if held else []) + fresh)
            fresh, held, flushes, flushed = [], 0, flushes + 1, True
        if flushed:
            self.records.clear()
            if due:
                self.handle.deleteTimer(due)
                due = 0
        if fresh:
            self.records.appendList(fresh)
            held += len(fresh)
            if not due:
                due = now + self.age
                self.handle.registerTimer(due)
        self.counts.update((held, flushes, due))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, flushes, _ = self.counts.get()
        if held:
            yield self._frame(key[0], flushes, AGE, list(self.records.get()))
            self.records.clear()
            flushes += 1
        self.counts.update((0, flushes, 0))

    def close(self) -> None:
        pass


def slot_of(key: str = "event_id", slots: int = 16) -> Column:
    """A writer slot by hash; records of one ticker are spread over all."""
    return F.pmod(F.xxhash64(key), F.lit(slots))


def flushes(
    records: DataFrame,
    slot: Column,
    size: int = LAKE_ROWS_PER_FILE,
    age: str = LAKE_FLUSH,
    stop: Column | None = None,
) -> DataFrame:
    """Records of a stream in flushes of ``size``, or of what is there when the oldest is ``age`` old.

    Adds slot, flush (numbered per slot) and reason.  Rows for which ``stop`` holds are no
    records: they flush what their slot still holds.
    """
    schema = T.StructType([f for f in records.schema.fields if f.name != "stop"])
    marked = records.select(
        slot.cast("long").alias("slot"),
        (F.lit(False) if stop is None else F.coalesce(stop, F.lit(False))).alias("stop"),
        F.to_json(F.struct(*schema.fieldNames()), _WIRE).alias("record"),
    )
    flushed = marked.groupBy("slot").transformWithStateInPandas(
        _Buffer(size, seconds(age)), _FLUSH, "Append", "ProcessingTime"
    )
    return flushed.select("slot", "flush", "reason", F.from_json("record", schema, _WIRE).alias("r")).select(
        "slot", "flush", "reason", "r.*"
    )


def to_flushed_lake(
    processed: DataFrame,
    path: str,
    checkpoint: str,
    every: str = "1 second",
    slots: int = 16,
    size: int = LAKE_ROWS_PER_FILE,
    age: str = LAKE_FLUSH,
    stop: Column | None = None,
) -> StreamingQuery:
    """Follow processed news into the lake by flushes, exactly once.

    ``every`` is how often the age of what is held is looked at.
    """
    filed = flushes(processed, slot_of(slots=slots), size, age, stop).select(*S.PROCESSED_NEWS.fieldNames())
    return to_lake(filed, path, checkpoint, every, size, stateful=True)
