"""Looking keys up in the index that the serving tables keep.

Every batch of a table writes, next to its rows, the keys of those rows under
``keys/<table>.<key>/batch_id=<batch>``, sorted by a hash prefix; merging turns many such
folders into one with a folder per prefix.  A lookup reads the folders of the wanted
keys' prefixes alone, and of what is not merged yet the row groups that may hold them,
so a small batch touches a small part of the history, however long that is.  A batch counts as indexed once its keys are
committed; rows of others -- written before there was an index, or by a job that
ended between rows and keys -- are read from the table itself, so a lookup
never misses a stored row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from newsmart.sources.tables import BATCH, read_table

#: Hash prefixes, and so folders of a merged index.
PREFIXES = 256
PREFIX = "prefix"
#: The batch that a key came with; merged folders hold the keys of many.
ORIGIN = "origin"
MERGED = "merged-"


def prefix_of(key: Column) -> Column:
    """Two hexadecimal digits of a key's hash."""
    return F.lpad(F.lower(F.hex(F.pmod(F.xxhash64(key.cast("string")), F.lit(PREFIXES)))), 2, "0")


def index_path(root: str, table: str, key: str) -> str:
    return f"{root}/keys/{table}.{key}"


def covers_path(root: str, table: str, key: str) -> str:
    """Which batches each merged folder holds."""
    return f"{root}/key-covers/{table}.{key}"


def batches(spark: SparkSession, path: str, committed: bool = False) -> list[str]:
    """Names of the batches that have a folder under a table's path."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = hadoop(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    names = [status.getPath() for status in system.listStatus(root) if status.isDirectory()]
    wanted = [p for p in names if p.getName().startswith(f"{BATCH}=")]
    if committed:
        wanted = [p for p in wanted if system.exists(hadoop(p, "_SUCCESS"))]
    return sorted(p.getName().partition("=")[2] for p in wanted)


def covered(spark: SparkSession, root: str, table: str, key: str) -> dict[str, set[str]]:
    """Batches by the merged folder that holds their keys."""
    path = covers_path(root, table, key)
    found: dict[str, set[str]] = {}
    names = batches(spark, path, committed=True)
    if names:
        schema = T.StructType([T.StructField(ORIGIN, T.StringType()), T.StructField(BATCH, T.StringType())])
        # One short name per batch ever merged, as many as the folders they stand for.
        for origin, merged in spark.read.schema(schema).parquet(path).where(F.col(BATCH).isin(names)).collect():
            found.setdefault(merged, set()).add(origin)
    return found


def folders(spark: SparkSession, root: str, table: str, key: str) -> tuple[list[str], set[str]]:
    """The index folders to read, and the batches whose keys they hold."""
    own = batches(spark, index_path(root, table, key), committed=True)
    whole = {m: c for m, c in covered(spark, root, table, key).items() if m in own}
    hidden = set().union(*(c for m, c in whole.items()))
    read = [b for b in own if b not in hidden]
    # A merged folder that a later one holds as well is hidden, its batches are not lost.
    return read, set(own) | hidden


def read_keys(
    spark: SparkSession, root: str, table: str, key: str, schema: T.StructType, names: Sequence[str]
) -> DataFrame:
    """Keys of the named index folders, with their origin and prefix."""
    path = index_path(root, table, key)
    text = [T.StructField(c, T.StringType()) for c in (ORIGIN, BATCH, PREFIX)]
    full = T.StructType([*schema.fields, *text])
    found = spark.createDataFrame([], full)
    merged = [n for n in names if n.startswith(MERGED)]
    # Apart, as the prefix is a column of the one kind and a folder of the other.
    for group in (merged, [n for n in names if n not in merged]):
        if group:
            paths = [f"{path}/{BATCH}={n}" for n in group]
            found = found.unionByName(spark.read.schema(full).option("basePath", path).parquet(*paths))
    return found


def stored_keys(
    wanted: DataFrame,
    root: str,
    table: str,
    schema: T.StructType,
    key: str,
    columns: Sequence[str],
    except_batch: str | None = None,
    name: str | None = None,
) -> DataFrame:
    """``columns`` of the stored rows of a table whose key, the first of them, is among ``wanted``.

    ``wanted`` has the column under ``name`` or the key's own; pass a stored frame, which is read
    twice.  ``except_batch`` is left out, as a replay is about to write it again.
    The driver sees which prefixes are wanted, at most ``PREFIXES`` of them.
    """
    spark = wanted.sparkSession
    own = T.StructType([schema[c] for c in columns])
    values = wanted.select(F.col(name or key).alias(key))
    prefixes = sorted(r[0] for r in values.select(prefix_of(F.col(key)).alias(PREFIX)).distinct().collect() if r[0])
    read, indexed = folders(spark, root, table, key)
    found = read_keys(spark, root, table, key, own, read).where(F.col(PREFIX).isin(prefixes))
    if except_batch is not None:
        found = found.where(F.col(ORIGIN) != except_batch)
    found = found.select(*columns)
    path = f"{root}/{table}"
    missing = [b for b in batches(spark, path) if b not in indexed and b != except_batch]
    if missing:
        found = found.unionByName(read_table(spark, path, schema, only=missing).select(*columns))
    return found.join(values.distinct(), key, "left_semi")
