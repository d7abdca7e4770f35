"""Topics: a broker, or a folder of envelopes that stands in for one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart import schemas as S


def broker_topics(
    spark: SparkSession, servers: str, topics: list[str], streaming: bool = True, **options: str
) -> DataFrame:
    """Records of the topics from the earliest offset as (topic, key, value).

    Needs the Kafka connector on the class path.
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = (
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    return reader.load().select("topic", F.expr("string(key)"), F.expr("string(value)"))


def landed_topics(
    spark: SparkSession, path: str, streaming: bool = True, **options: str
) -> DataFrame:
    """Envelopes from a Parquet folder, as (topic, key, value)."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(S.ENVELOPE).options(**options).parquet(path)


def topic_values(envelopes: DataFrame, topic: str) -> DataFrame:
    """Records of one topic; tombstones are dropped."""
    return envelopes.where((F.col("topic") == topic) & F.col("value").isNotNull())


def admission_options(requests_per_minute: int, trigger_seconds: int) -> dict[str, str]:
    """Broker option that admits no more rows per trigger than the model may be asked.

    A trigger too short for a single request is refused.
    """
    per_trigger = requests_per_minute * trigger_seconds // 60
    if per_trigger < 1:
        raise ValueError("the trigger is shorter than the time between two requests")
    return {"maxOffsetsPerTrigger": str(per_trigger)}
