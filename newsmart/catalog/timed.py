"""Streams that act when time has passed, followed over two drops of records and a restart."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from newsmart import bindings as B, schemas as S
from newsmart.catalog.registry import ARTICLE_SQL, NEWS, article_columns, company, query
from newsmart.operators.aggregate import by_ticker
from newsmart.session import scratch_path
from newsmart.sources.tables import read_folder
from newsmart.streaming.streams import to_folder
from newsmart.streaming.timers import flushes, tick_snapshots

#: Seconds that a timer may take on a busy machine, and further ones for each record.
PATIENCE, PER_RECORD = 120, 1 / 500
TICK, AGE = "6 seconds", "6 seconds"
SLOTS, SIZE = 4, 20

_RECORD = T.StructType([*S.PROCESSED_NEWS.fields, T.StructField("stop", T.BooleanType())])
_LATER = "(doc_id // 4) % 2"


def _number() -> Column:
    return F.right("event_id", F.lit(12)).cast("long")


def _drop(spark: SparkSession, sf_dir: str, part: int, path: str) -> DataFrame:
    """Land one of two parts of the news, and return it."""
    own = B.articles(spark, sf_dir).where(F.floor(_number() / 4) % 2 == part)
    own.withColumn("stop", F.lit(False)).select(*_RECORD.fieldNames()).write.mode("append").parquet(path)
    return own


def _until(stream: StreamingQuery, done: Callable[[], bool], records: int) -> None:
    """Wait for a running stream that takes so many records in, then stop it."""
    end = time.monotonic() + PATIENCE + records * PER_RECORD
    try:
        while not done():
            if not stream.isActive:
                raise RuntimeError("the stream ended") from stream.exception()
            if time.monotonic() > end:
                raise TimeoutError("the stream did not get there")
            time.sleep(0.5)
    finally:
        stream.stop()


@query(
    f"""with {NEWS}, spread as (select {_LATER} as part, score, unnest(tickers) as ticker from news),
    counted as (
      select ticker, part, count(*) as article_count, round(avg(score), 6) as avg_sentiment_score
      from spread group by ticker, part)
    select ticker, {company('ticker')} as company_name,
           cast(row_number() over (partition by ticker order by part) as integer) as nth,
           article_count, avg_sentiment_score, true as within_a_tick
    from counted"""
)
def stream_timer_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows from first arrival to tick: one for each drop; the second is held over a restart."""
    out = scratch_path(spark, "ticks")
    expected = 0
    for part in range(2):
        expected += by_ticker(_drop(spark, sf_dir, part, f"{out}/in")).count()
        snapshots = tick_snapshots(spark.readStream.schema(_RECORD).parquet(f"{out}/in"), TICK)

        def run() -> StreamingQuery:
            return to_folder(snapshots, f"{out}/data", f"{out}/checkpoint", "1 second")

        def emitted() -> bool:
            total = read_folder(spark, f"{out}/data", snapshots.schema).agg(F.sum("article_count")).first()[0]
            return (total or 0) == expected

        if part:  # taken in, then stopped before or after its tick
            _until(stream := run(), lambda: any(p.numInputRows for p in stream.recentProgress), expected)
        _until(run(), emitted, expected)
    windows = read_folder(spark, f"{out}/data", snapshots.schema)
    earlier = windows.select(F.col("ticker").alias("t"), F.col("window_start").alias("s"))
    length = F.col("window_end").cast("double") - F.col("window_start").cast("double")
    numbered = (
        windows.join(earlier, (F.col("ticker") == F.col("t")) & (F.col("s") <= F.col("window_start")))
        .groupBy(*windows.columns)
        .agg(F.count("*").cast("int").alias("nth"))
    )
    return numbered.select(
        "ticker",
        "company_name",
        "nth",
        "article_count",
        F.round("avg_sentiment_score", 6).alias("avg_sentiment_score"),
        ((length > 0) & (length <= float(TICK.split()[0]))).alias("within_a_tick"),
    )


def _flushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops through the buffers: one ends by age, the other by a request to stop."""
    out = scratch_path(spark, "flushes")
    expected = 0
    for part in range(2):
        expected += _drop(spark, sf_dir, part, f"{out}/in").count()
        if part:
            marker = spark.range(SLOTS).select(
                F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(F.col("id").cast("string"), 12, "0")).alias("event_id"),
                F.lit(True).alias("stop"),
            )
            empty = spark.createDataFrame([], _RECORD)
            empty.unionByName(marker, allowMissingColumns=True).write.mode("append").parquet(f"{out}/in")
        records = spark.readStream.schema(_RECORD).parquet(f"{out}/in")
        buffered = flushes(records, _number() % SLOTS, SIZE, AGE, F.col("stop"))
        stream = to_folder(buffered, f"{out}/data", f"{out}/checkpoint", "1 second")
        _until(stream, lambda: read_folder(spark, f"{out}/data", buffered.schema).count() == expected, expected)
    return read_folder(spark, f"{out}/data", buffered.schema)


@query(
    f"""with {NEWS}, parts as (
      select doc_id % {SLOTS} as slot, {_LATER} as part, count(*) as n from news group by all)
    select slot, 'size' as reason, sum(n // {SIZE}) as n_flushes, sum(n // {SIZE} * {SIZE}) as n_rows
    from parts group by slot having sum(n // {SIZE}) > 0
    union all
    select slot, case part when 0 then 'age' else 'stop' end, 1, n % {SIZE} from parts where n % {SIZE} > 0"""
)
def stream_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flushes per slot and reason, and the records in them."""
    whole = _flushed(spark, sf_dir).groupBy("slot", "flush", "reason").agg(F.count("*").alias("n"))
    return whole.groupBy("slot", "reason").agg(F.count("*").alias("n_flushes"), F.sum("n").alias("n_rows"))


@query(f"with {NEWS} select {ARTICLE_SQL}, content_hash, doc_id % {SLOTS} as slot from news")
def stream_flush_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record that went through the buffers, whole and once."""
    return _flushed(spark, sf_dir).select(*article_columns(), "content_hash", "slot")
