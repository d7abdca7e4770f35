"""The partitioned Parquet lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart.operators.lake import event_date, lake_rows

PARTITIONS = ("date", "ticker")


def lay_out(processed: DataFrame) -> DataFrame:
    """Bring each day's articles together without letting a hot day fill a task.

    REBALANCE shuffles by date and lets AQE split what is too large and merge what is too
    small, so file sizes follow the data.  By date alone, ahead of ``lake_rows``: an
    article's text is then shuffled once, not once per ticker, and a task that writes a
    day's folders makes the day's own once, not one task per ticker.
    """
    return processed.withColumn("date", event_date(F.col("timestamp"))).hint("rebalance", "date")


def lake_kind(spark: SparkSession, path: str) -> str | None:
    """Whether batch jobs or a stream have written to the lake, or nobody yet."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = files(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(files(root, "_spark_metadata")):
        return "stream"
    return "batch" if system.exists(root) and len(system.listStatus(root)) else None


def write_lake(
    processed: DataFrame, path: str, rows_per_file: int = 0, mode: str = "append"
) -> None:
    """File each article once per ticker occurrence under date and ticker.

    ``rows_per_file`` caps a file (0: no cap).  ``mode="overwrite"`` replaces the
    date and ticker folders the batch has rows for and no others, so a job over
    whole days can be run again.  A lake that a stream writes is refused, since
    readers would not see the rows.
    """
    if lake_kind(processed.sparkSession, path) == "stream":
        raise ValueError(f"{path} is written by a stream")
    (
        lake_rows(lay_out(processed))
        .write.partitionBy(*PARTITIONS)
        .option("maxRecordsPerFile", rows_per_file)
        .option("partitionOverwriteMode", "dynamic")
        .mode(mode)
        .parquet(path)
    )


def spread(rows: DataFrame, tasks_per_partition: int = 8) -> DataFrame:
    """``lay_out`` of lake rows for a stream that keeps state, whose shuffles AQE leaves alone.

    A hot partition is spread over a fixed number of tasks by a salt taken from
    the event id, which comes out the same on replay.
    """
    salt = F.pmod(F.xxhash64("event_id"), F.lit(tasks_per_partition))
    return rows.repartition(*[F.col(c) for c in PARTITIONS], salt)
