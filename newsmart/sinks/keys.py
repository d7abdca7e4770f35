"""Keeping the index of stored keys: a small sorted folder per batch, merged from time to time."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from newsmart.sources.keys import (
    MERGED,
    ORIGIN,
    PREFIX,
    PREFIXES,
    covered,
    covers_path,
    folders,
    index_path,
    prefix_of,
    read_keys,
)
from newsmart.sources.tables import BATCH


def write_keys(
    stored_rows: DataFrame, root: str, table: str, batch_id: str, key: str, columns: Sequence[str]
) -> None:
    """Index the rows that a batch has stored, after they are stored; a replay writes the same again."""
    rows = stored_rows.select(*columns, F.lit(batch_id).alias(ORIGIN), prefix_of(F.col(key)).alias(PREFIX))
    # Sorted, and as few files as the batch needs: its row groups have narrow ranges of prefixes.
    ordered = rows.where(F.col(key).isNotNull()).orderBy(PREFIX, key)
    ordered.write.mode("overwrite").parquet(f"{index_path(root, table, key)}/{BATCH}={batch_id}")


def merge_keys(
    spark: SparkSession, root: str, table: str, schema: T.StructType, key: str, columns: Sequence[str]
) -> str | None:
    """Merge the committed folders of an index into one of a folder per prefix, and return its name.

    Readers see either the folders it replaces or, once the list of what it covers is
    committed, the merged one; both hold the same keys.  Replaced folders stay until the
    owner deletes them.  Nothing is merged where fewer than two folders are read.
    """
    read, _ = folders(spark, root, table, key)
    if len(read) < 2:
        return None
    name = f"{MERGED}{uuid.uuid4().hex}"
    own = T.StructType([schema[c] for c in columns])
    rows = read_keys(spark, root, table, key, own, read).select(*columns, ORIGIN, PREFIX)
    tasks = min(PREFIXES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartition(tasks, PREFIX).sortWithinPartitions(PREFIX, key)
    dealt.write.partitionBy(PREFIX).parquet(f"{index_path(root, table, key)}/{BATCH}={name}")
    held = covered(spark, root, table, key)
    whole = set(read).union(*(held.get(b, ()) for b in read))
    covers = spark.createDataFrame([(b,) for b in sorted(whole)], f"{ORIGIN} string")
    covers.coalesce(1).write.parquet(f"{covers_path(root, table, key)}/{BATCH}={name}")
    return name
