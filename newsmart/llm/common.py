"""What the operators share: tables, stored steps, Bloom filters, batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsmart.llm.words import mix
from newsmart.session import configure, scratch_path

#: Rows of one Arrow batch, so that a batch of long texts stays small.
BATCH_ROWS = "500"


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings the operators rely on."""
    configure(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back.

    The step is then computed once, survives lost executors, and its size is
    known to the planner.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def by_row(
    work: Callable[..., Iterator[tuple]], columns: list[str], names: list[str]
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A mapInPandas function from ``work(*values of columns)``, rows out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for values in zip(*(batch[c].array for c in columns), strict=True):
                rows.extend(work(*(None if v is pd.NA else v for v in values)))
            yield pd.DataFrame(rows, columns=names)

    return run


def row_key(frame: DataFrame, *more: str) -> Column:
    """What tells rows apart: a hash of the id, the hash of the text, and ``more`` columns; null is a value."""
    parts = [frame["doc_id"].cast("long"), F.xxhash64(frame["text"].cast("string")), frame["text"].isNull()]
    parts += [frame[c].cast("string") for c in more]
    return F.xxhash64(*(x for part in parts for x in (part, part.isNull())))


def text_of(value: object) -> str:
    """The text of a cell; null is empty."""
    return value if isinstance(value, str) else ""


# --- Bloom filter of a bounded size -------------------------------------------

#: Bits of a filter: 64 per key or more, at least 2^16 and at most 2^27 (16 MB).
BLOOM_LOG2 = (16, 27)
_PROBES = 4


def _mixed(keys: np.ndarray) -> np.ndarray:
    return mix(np.ascontiguousarray(keys).view(np.uint64))


def _probe(mixed: np.ndarray, i: int, log2: int) -> np.ndarray:
    step = (mixed >> np.uint64(32)) | np.uint64(1)
    return (mixed + np.uint64(i) * step) & np.uint64((1 << log2) - 1)


class Bloom:
    """Membership of 64-bit keys, with false positives; its size is bounded.

    It only thins what is shuffled, so a join decides afterwards and a filter
    that is too full costs time, never rows.
    """

    def __init__(self, log2: int, cells: np.ndarray):
        self.log2, self.cells = log2, cells

    def holds(self, keys: np.ndarray) -> np.ndarray:
        mixed = _mixed(keys)
        left = np.arange(len(mixed))
        for i in range(_PROBES):
            at = _probe(mixed[left], i, self.log2)
            left = left[(self.cells[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        found = np.zeros(len(mixed), bool)
        found[left] = True
        return found


def bloom_of(frame: DataFrame, key: str) -> Bloom:
    """A filter of a long column, summed up on the executors.

    The driver gets its cells, 16 MB at most whatever the number of keys.
    """
    n = frame.count()
    log2 = min(max(int(max(n, 1) * 64 - 1).bit_length(), BLOOM_LOG2[0]), BLOOM_LOG2[1])

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.zeros(1 << (log2 - 3), np.uint8)
        for batch in batches:
            mixed = _mixed(batch["key"].to_numpy(np.int64))
            for at in (_probe(mixed, i, log2) for i in range(_PROBES)):
                np.bitwise_or.at(own, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        words = own.view(np.int64)
        at = np.flatnonzero(words)
        yield pd.DataFrame({"at": at.astype(np.int64), "bits": words[at]})

    parts = (
        frame.select(F.col(key).cast("long").alias("key"))
        .where("key is not null")
        .mapInPandas(cells, "at long, bits long")
        .groupBy("at")
        .agg(F.bit_or("bits").alias("bits"))
        .toPandas()
    )
    whole = np.zeros(1 << (log2 - 6), np.int64)
    whole[parts["at"].to_numpy(np.int64)] = parts["bits"].to_numpy(np.int64)
    return Bloom(log2, whole.view(np.uint8))
