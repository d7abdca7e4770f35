"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on.  All can be changed on a running session, so
# they are applied to whatever session a caller brings.
_RUNTIME = {
    # Timestamps are instants; dates and windows are taken in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Coalesces small shuffle partitions, splits skewed ones, and lets a join
    # whose side turns out small become a broadcast join.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Timestamps with min/max statistics, so time filters skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Python workers hold a batch of whole texts: its rows bound their memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Stream state beyond executor memory goes to local disk and is
    # snapshotted to the checkpoint folder.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to an existing session."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    for key, value in _RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("newsmart")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session that names none gets one of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder and folder.startswith("file:") and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names a folder of one machine")
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="newsmart-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back.

    It is then computed once, outlives lost executors, and its size is known to
    the planner, which chooses joins by it.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/newsmart/{name}-{uuid.uuid4().hex}"
