"""Starting the streams.

Offsets, state and sink commits live in the checkpoint folder, so a restarted
query goes on where it stopped.  Each sink is its own query with its own
checkpoint: a slow sink does not hold back another.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from newsmart.operators.annotate import Complete
from newsmart.operators.lake import lake_rows
from newsmart.plans.news import annotate_articles
from newsmart.schemas import ANALYSIS_TOPIC
from newsmart.sinks.lake import PARTITIONS, lake_kind, lay_out, spread
from newsmart.sources.tables import VERSION, drop_versions
from newsmart.sinks.tables import (
    DEAD,
    write_aggregates,
    write_analyses,
    write_batch,
    write_topics,
)

# Lake flush settings and the aggregate emit interval.
LAKE_ROWS_PER_FILE = 100  # for files as small as the service's; 0 leaves the size to the data
LAKE_FLUSH = "60 seconds"
EMIT_INTERVAL = "300 seconds"
#: Versions of a snapshot that stay.
KEPT_VERSIONS = 3


def start(writer: DataStreamWriter, every: str | None) -> StreamingQuery:
    """Start with a timer, or, without one, take what is there and stop."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def own_name(batch: DataFrame, kind: str, batch_id: int) -> str:
    """Name of a micro-batch, the same on a replay and used by no other stream.

    The query's id is kept in its checkpoint.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise ValueError("a micro-batch is named inside its stream only")
    return f"{kind}-{query}-{batch_id}"


def to_folder(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return start(writer.outputMode("append").option("path", path), every)


def to_snapshot(
    df: DataFrame, path: str, checkpoint: str, every: str | None = EMIT_INTERVAL
) -> StreamingQuery:
    """The running aggregate as a version of its own at every trigger, under ``path``.

    ``sources.tables.read_snapshot`` reads the newest whole one, so a reader never meets
    one that is being written.  The last ``KEPT_VERSIONS`` stay for readers at work.  In
    complete mode the state holds every group ever seen: for windows that end, give
    ``to_folder`` an aggregate with a watermark, which emits a window once and forgets it.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{VERSION}={batch_id:012d}")
        drop_versions(batch.sparkSession, path, KEPT_VERSIONS)

    writer = df.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    return start(writer.foreachBatch(replace), every)


def to_aggregates(
    aggregates: DataFrame, root: str, checkpoint: str, every: str | None = EMIT_INTERVAL
) -> StreamingQuery:
    """Append the windows that changed since the last trigger to the aggregate table.

    A window that is still filling is emitted again with its new count, as a
    further snapshot of it.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        write_aggregates(batch, root, own_name(batch, "aggregates", batch_id))

    writer = aggregates.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return start(writer.foreachBatch(store), every)


def to_analyses(
    processed: DataFrame,
    root: str,
    checkpoint: str,
    make_complete: Callable[[], Complete],
    model_id: str,
    every: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Annotate processed news and store the analyses next to the articles.

    Bound the rows per trigger at the source (``topics.admission_options``) to
    keep to the model's request rate.
    """

    def annotate(batch: DataFrame, batch_id: int) -> None:
        news, name = batch.persist(), own_name(batch, "annotator", batch_id)
        held = [news]
        try:
            analyses, failed = annotate_articles(
                news,
                f"{root}/replies",
                make_complete,
                model_id,
                F.current_timestamp(),
                partitions=partitions,
            )
            analyses = analyses.persist()  # read several times below; parsed once
            held.append(analyses)
            orphans = write_analyses(analyses, root, name)
            failures = failed.select(
                F.lit(ANALYSIS_TOPIC).alias("topic"), F.col("reply").alias("value"), "reason"
            )
            write_batch(orphans.unionByName(failures), f"{root}/{DEAD}", name)
        finally:
            for frame in held:
                frame.unpersist()

    writer = processed.writeStream.option("checkpointLocation", checkpoint)
    return start(writer.foreachBatch(annotate), every)


def to_lake(
    processed: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = LAKE_FLUSH,
    rows_per_file: int = 0,
    stateful: bool = False,
) -> StreamingQuery:
    """Append processed news to the lake, exactly once.

    ``rows_per_file`` caps a file (``LAKE_ROWS_PER_FILE`` for the service's own
    setting, 0 for none).  A stream's log of files rules what readers see, so a
    lake that batch jobs write is refused: give each a root of its own.
    Spark does not re-plan a stream that keeps state: say so with ``stateful``
    and hot partitions are spread by hand.
    """
    if lake_kind(processed.sparkSession, path) == "batch":
        raise ValueError(f"{path} is written by batch jobs")
    writer = (
        (spread(lake_rows(processed)) if stateful else lake_rows(lay_out(processed)))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*PARTITIONS)
        .option("path", path)
    )
    return start(writer.outputMode("append"), every)


def to_tables(
    envelopes: DataFrame, root: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Store mixed topic records in the serving tables."""

    def store(batch: DataFrame, batch_id: int) -> None:
        write_topics(batch, root, own_name(batch, "topics", batch_id))

    writer = envelopes.writeStream.option("checkpointLocation", checkpoint)
    return start(writer.foreachBatch(store), every)


# Which sinks a selection runs.
_SINKS = {
    "console": ("console",),
    "db_sink": ("tables",),
    "s3_sink": ("lake",),
    "all": ("tables", "lake"),
}


def fan_out(
    selection: str,
    processed: DataFrame,
    envelopes: DataFrame,
    root: str,
    checkpoints: str,
    every: str | None = None,
) -> dict[str, StreamingQuery]:
    """Start the selected sinks side by side, each with its own progress."""
    names = _SINKS.get(selection.lower())
    if names is None:
        raise ValueError(f"unknown sink selection: {selection}")
    begin = {
        "tables": lambda: to_tables(envelopes, f"{root}/serving", f"{checkpoints}/tables", every),
        "lake": lambda: to_lake(processed, f"{root}/lake", f"{checkpoints}/lake", every),
        "console": lambda: start(
            processed.writeStream.format("console").option(
                "checkpointLocation", f"{checkpoints}/console"
            ),
            every,
        ),
    }
    return {name: begin[name]() for name in names}
