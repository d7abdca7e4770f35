"""JSON form of a record on a topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from newsmart.functions.times import WIRE_TIMESTAMP

# Nulls are written out, as the consumers of the topics expect.
_WRITE = {"ignoreNullFields": "false", "timestampFormat": WIRE_TIMESTAMP}


def encode(schema: T.StructType) -> Column:
    """The row's ``schema`` columns as one JSON object; metadata goes in as it is written."""

    def field(name: str) -> Column:
        return F.lit("").alias(name) if name == "raw_metadata" else F.col(name)

    record = F.to_json(F.struct(*[field(name) for name in schema.fieldNames()]), _WRITE)
    if "raw_metadata" not in schema.fieldNames():
        return record
    # Quotes inside a value are escaped, so the empty field stands once.
    text = F.coalesce(F.col("raw_metadata"), F.lit("null"))
    return F.replace(record, F.lit('"raw_metadata":""'), F.concat(F.lit('"raw_metadata":'), text))


def envelope(df: DataFrame, schema: T.StructType, topic: str, key: Column | None) -> DataFrame:
    """Rows as (topic, key, value) records ready for a topic."""
    key = F.lit(None) if key is None else key
    return df.select(
        F.lit(topic).alias("topic"),
        key.cast("string").alias("key"),
        encode(schema).alias("value"),
    )
