"""Publishing envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def publish(envelopes: DataFrame, servers: str, **options: str) -> None:
    """Send (topic, key, value) rows to a broker; needs the Kafka connector."""
    (
        envelopes.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .options(**options)
        .save()
    )


def publish_stream(
    envelopes: DataFrame, servers: str, checkpoint: str, **options: str
) -> DataStreamWriter:
    """The same for a stream; the caller sets a trigger and starts it."""
    return (
        envelopes.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )


def land(envelopes: DataFrame, path: str, mode: str = "append") -> None:
    """Write envelopes to a folder that stands in for the topics."""
    envelopes.write.mode(mode).parquet(path)
