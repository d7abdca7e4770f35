"""Stored tables: serving tables in batch folders, and the partitioned lake."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from newsmart import schemas as S

BATCH = "batch_id"
VERSION = "version"


def read_folder(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table; one nobody has written to yet is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    except_batch: str | None = None,
    only: list[str] | None = None,
) -> DataFrame:
    """A serving table, without the batch a replay is about to write again, or of some batches only."""
    table = read_folder(spark, path, T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())]))
    if except_batch is not None:
        table = table.where(F.col(BATCH) != except_batch)
    if only is not None:
        table = table.where(F.col(BATCH).isin(only))
    return table.drop(BATCH)


def read_replies(spark: SparkSession, path: str, model_id: str, version: str) -> DataFrame:
    """Answers of one model and version."""
    return read_folder(spark, path, S.REPLY).where(
        (F.col("model_id") == model_id) & (F.col("analysis_version") == version)
    )


def read_lake(
    spark: SparkSession, path: str, ticker: str | None = None, since: str | None = None
) -> DataFrame:
    """The lake; ``ticker`` and ``since`` (a date) prune folders."""
    lake = spark.read.schema(lake_schema()).parquet(path)
    if ticker:
        lake = lake.where(F.col("ticker") == ticker)
    if since:
        lake = lake.where(F.col("date") >= F.lit(since).cast("date"))
    return lake


def lake_schema() -> T.StructType:
    fields = [S.PROCESSED_NEWS[c] for c in S.LAKE_COLUMNS]
    parts = [T.StructField("date", T.DateType()), T.StructField("ticker", T.StringType())]
    return T.StructType(fields + parts)


# --- snapshots --------------------------------------------------------------------------


def _versions(spark: SparkSession, path: str) -> list:
    """Folders of the whole versions under a path, oldest first, and their file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = hadoop(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(root):
        return [system]
    found = [s.getPath() for s in system.listStatus(root) if s.getPath().getName().startswith(f"{VERSION}=")]
    return [system, *sorted((p for p in found if system.exists(hadoop(p, "_SUCCESS"))), key=lambda p: p.getName())]


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest version of a snapshot that is wholly written; none yet is empty."""
    _, *versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(versions[-1].toString())


def drop_versions(spark: SparkSession, path: str, keep: int) -> None:
    """Delete all but the newest whole versions of a snapshot."""
    system, *versions = _versions(spark, path)
    for old in versions[:-keep]:
        system.delete(old, True)
