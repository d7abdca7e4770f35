"""De-duplication with a defined survivor.

``row_number() = 1`` lets Catalyst keep one row per key in every map task
before the shuffle (``WindowGroupLimit``), so a key that holds a third of the
rows reaches the reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsmart.session import stored

_RANK = "_rank"


def first_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column], k: int = 1
) -> DataFrame:
    """The first ``k`` rows of each key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) <= k).drop(_RANK)


def dedup_source_url(raw: DataFrame) -> DataFrame:
    """One row per source URL, the earliest; rows without one are kept."""
    key = F.coalesce("source_url", "event_id")
    return first_per_key(raw, [key], ["timestamp", "event_id"])


def dedup_entry(raw: DataFrame) -> DataFrame:
    """One row per filing entry key, the earliest; keyless entries share one."""
    return first_per_key(raw, ["entry_key"], ["timestamp", "event_id"]).drop("entry_key")


def dedup_content(news: DataFrame) -> DataFrame:
    """One row per content hash, the earliest."""
    return first_per_key(news, ["content_hash"], ["timestamp", "event_id"])


# --- text left in place ---------------------------------------------------------------

#: Most rows of the broadcast table of bits: 2^20 words of 64 bits, 16 MB.
_MOST_WORDS = 1 << 20


def _word(key: Column, words: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 6).bitwiseAND(F.lit(words - 1))


def _bit(key: Column) -> Column:
    place = F.xxhash64(key).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def by_membership(df: DataFrame, key: Column, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is not in ``wanted``, and the others, among which are a few of the first kind.

    ``wanted`` is a stored frame whose one column is ``_key``.  It becomes a table of bits, at
    most ``_MOST_WORDS`` rows however many keys there are, which is broadcast and decides row
    by row where the rows are read.
    """
    # 32 bits per key, as long as there is room.
    words = min(_MOST_WORDS, 1 << max(6, (wanted.count() // 2).bit_length()))
    word, bit = _word(F.col("_key"), words), _bit(F.col("_key"))
    bits = wanted.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    marked = df.withColumn("_at", _word(key, words)).join(F.broadcast(bits), F.col("_at") == F.col("_word"), "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(_bit(key)) != 0, F.lit(False))
    return marked.where(~maybe).select(*df.columns), marked.where(maybe).select(*df.columns)


def by_repetition(df: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """Rows whose key stands once, and the others, among which are a few of the first kind.

    Keys alone are counted; those that stand more than once are looked for in place.
    """
    repeated = df.select(key.alias("_key")).groupBy("_key").count().where("count > 1").select("_key")
    return by_membership(df, key, stored(repeated, "repeated-keys"))


def first_in_place(df: DataFrame, key: str | Column, order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key, shuffling only rows whose key stands more than once.

    ``df`` is read three times and must not be a stream; where most keys repeat,
    ``first_per_key`` does the same in one reading.
    """
    key = F.col(key) if isinstance(key, str) else key
    single, several = by_repetition(df, key)
    return single.unionByName(first_per_key(several, [key], order))


def stream_dedup(
    df: DataFrame, key: str, delay: str, time: str, salts: int = 16
) -> DataFrame:
    """One row per key on a stream, with state kept for ``delay`` of ``time``.

    Spark drops rows that are later than the delay.  With an arrival time there
    are none; with the event time an article published long ago is one.

    A window cannot pre-aggregate on a stream, so the first pass spreads each
    key over ``salts`` tasks by the input partition its rows come from (the same
    when a task is run again), and the second joins what is left: a hot key
    reaches its final task at most ``salts`` times per ``delay``.  ``salts=1``
    is the single pass.
    """
    marked = df.withWatermark(time, delay)
    if salts > 1:
        marked = marked.withColumn("_salt", F.spark_partition_id() % salts)
        marked = marked.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark([key])
