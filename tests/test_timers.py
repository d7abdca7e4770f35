from __future__ import annotations

import time

import pandas as pd
from pyspark.sql import functions as F

from newsmart.sources.tables import read_folder, read_lake
from newsmart.streaming import streams, timers
from test_keys import articles


def until(stream, done, patience=90):
    end = time.monotonic() + patience
    try:
        while not done():
            assert stream.isActive, stream.exception()
            assert time.monotonic() < end, stream.lastProgress
            time.sleep(0.3)
    finally:
        stream.stop()


def test_seconds():
    assert timers.seconds("300 seconds") == 300 and timers.seconds("2 minutes") == 120


def test_a_window_opens_at_its_first_article_and_is_emitted_once(spark, folder):
    rows = articles(spark, range(50)).withColumn("tickers", F.array(F.lit("AAPL"), F.lit("AAPL"), F.lit("zz")))
    rows.coalesce(1).write.parquet(f"{folder}/in")
    news = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    snapshots = timers.tick_snapshots(news, "3 seconds")
    stream = streams.to_folder(snapshots, f"{folder}/out", f"{folder}/c", "1 second")
    until(stream, lambda: read_folder(spark, f"{folder}/out", snapshots.schema).count() == 2)
    again = streams.to_folder(snapshots, f"{folder}/out", f"{folder}/c", "1 second")
    began = time.monotonic()
    until(again, lambda: time.monotonic() - began > 12)
    made = sorted(read_folder(spark, f"{folder}/out", snapshots.schema).collect())
    assert [(r.ticker, r.company_name, r.article_count, r.avg_sentiment_score) for r in made] == [
        ("AAPL", "Apple Inc.", 100, None), ("zz", "zz", 50, None),
    ]
    assert all(0 < (r.window_end - r.window_start).total_seconds() <= 3 for r in made)


class _State:
    """What a processor keeps, and its timers."""

    def __init__(self):
        self.rows, self.value, self.timers = [], None, set()

    def get(self):
        return self.value if self.value is not None else iter(self.rows)

    def update(self, value):
        self.value = value

    def appendList(self, rows):
        self.rows += rows

    def clear(self):
        self.rows = []

    registerTimer = property(lambda self: self.timers.add)
    deleteTimer = property(lambda self: self.timers.remove)

    def getCurrentProcessingTimeInMs(self):
        return 1000


def test_a_buffer_gives_out_what_is_full_before_it_takes_more_in():
    buffer = timers._Buffer(10, 6)
    buffer.handle, buffer.records, buffer.counts = _State(), _State(), _State()
    buffer.counts.value = (0, 0, 0)
    taken = 0

    def rows(batches, stop=False):
        nonlocal taken
        for n in batches:
            taken += n
            records = [str(i) for i in range(taken - n, taken)]
            yield pd.DataFrame({"stop": [False] * n + [True] * stop, "record": records + [None] * stop})

    given = []
    for frame in buffer.handleInputRows((3,), rows([7, 8, 25, 5, 64]), buffer.handle):
        given += list(frame["record"])
        assert frame["reason"].iloc[0] == "size" and len(frame) == 10
        assert taken - len(given) < 10 + 64 and (len(given) > 40 or taken <= 45)
    assert len(given) == 100 and buffer.counts.value == (9, 10, 7000) and buffer.handle.timers == {7000}
    last = list(buffer.handleInputRows((3,), rows([3], stop=True), buffer.handle))
    assert [(f["flush"].iloc[0], f["reason"].iloc[0], len(f)) for f in last] == [(10, "size", 10), (11, "stop", 2)]
    given += [r for f in last for r in f["record"]]
    assert given == [str(i) for i in range(112)]
    assert buffer.counts.value == (0, 12, 0) and buffer.handle.timers == set() and buffer.records.rows == []


def test_flushes_reach_the_lake(spark, folder):
    rows = articles(spark, range(45))
    rows.coalesce(1).write.parquet(f"{folder}/in")
    news = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    stream = timers.to_flushed_lake(news, f"{folder}/lake", f"{folder}/c", slots=2, size=10, age="2 seconds")

    def filed():
        try:
            return read_lake(spark, f"{folder}/lake").count() == 45
        except Exception as problem:
            assert "PATH_NOT_FOUND" in str(problem)
            return False

    until(stream, filed)
    assert {r.event_id for r in read_lake(spark, f"{folder}/lake").collect()} == {f"e{i}" for i in range(45)}
