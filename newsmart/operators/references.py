"""Checks between stored records: foreign keys and insert-ignore."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, functions as F

from newsmart.operators.chains import resolve
from newsmart.operators.dedup import by_membership, first_per_key
from newsmart.session import stored


def _salted(analyses: DataFrame, articles: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    ids = articles.select(F.col("event_id").alias("article_event_id"))
    if salts <= 1:
        return analyses, ids
    # A salt from the whole row spreads one article's analyses over many tasks.
    salt = F.pmod(F.xxhash64(*analyses.columns), F.lit(salts)).cast("int")
    salted = analyses.withColumn("_salt", salt)
    # An article is repeated for the salts its analyses have, not for all there are: Spark
    # takes no account of rows that an explode adds, and would broadcast them.
    return salted, salted.select(*_keys(salts)).distinct().join(ids, "article_event_id", "left_semi")


def _keys(salts: int) -> list[str]:
    return ["article_event_id"] if salts <= 1 else ["article_event_id", "_salt"]


def valid_analyses(analyses: DataFrame, articles: DataFrame, salts: int = 1) -> DataFrame:
    """Analyses whose article exists.

    An article with very many analyses makes its partition skewed; AQE splits
    it.  Where AQE is off (inside a stateful stream), ``salts`` splits it by
    hand at the price of a second reading of ``analyses``: persist them.
    """
    left, right = _salted(analyses, articles, salts)
    return left.join(right, _keys(salts), "left_semi").select(*analyses.columns)


def orphan_analyses(analyses: DataFrame, articles: DataFrame, salts: int = 1) -> DataFrame:
    """Analyses whose article does not exist."""
    left, right = _salted(analyses, articles, salts)
    return left.join(right, _keys(salts), "left_anti").select(*analyses.columns)


def present(table: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The keys of ``wanted`` that the table has, each once.

    Pass a stored ``wanted``: Spark then knows its size, and broadcasts it or
    shuffles both sides accordingly.
    """
    return table.select(key).join(wanted.select(key), key, "left_semi").distinct()


#: Gives the stored keys among those wanted: ``look_up(wanted, key)`` has the column ``key``, each value once.
Lookup = Callable[[DataFrame, str], DataFrame]

#: Rounds that settle rows nothing stands before, ahead of the search through chains.
_PLAIN_ROUNDS = 3
_IDENTITY = ["event_id", "content_hash"]
_ORDER = ["timestamp", "event_id", "content_hash"]


def _certain_round(left: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that are the first left for both their content and their id, and what they leave open."""
    first_of_content = first_per_key(left, ["content_hash"], _ORDER)
    first_of_id = first_per_key(left, ["event_id"], _ORDER).select(*_IDENTITY)
    certain = stored(first_of_content.join(first_of_id, _IDENTITY, "left_semi"), "settled")
    for key in _IDENTITY:
        left = left.join(certain.select(key), key, "left_anti")
    return certain, stored(left, "unsettled")


def _contested(left: DataFrame) -> bool:
    """Whether an id brings several contents."""
    return not left.groupBy("event_id").count().where("count > 1").isEmpty()


def _settle(left: DataFrame) -> DataFrame:
    """The rows that get stored when rows compete for contents and for ids.

    Rows count in time order: one is stored if neither its content nor its id
    is taken by then.  While no id brings several contents, that is the first
    row of each content.  Otherwise a row that is the first left for both its
    content and its id is certain and settles all rows that share either.  A few
    such rounds leave little but chains of rows that wait for each other, which
    ``chains.resolve`` settles in a number of jobs that grows with the logarithm of a
    chain's length.
    """
    settled = left.limit(0)
    for _ in range(_PLAIN_ROUNDS):
        if not _contested(left):
            break
        certain, left = _certain_round(left)
        settled = settled.unionByName(certain)
    if _contested(left):
        return settled.unionByName(resolve(left, "content_hash", "event_id", _ORDER))
    return settled.unionByName(first_per_key(left, ["content_hash"], _ORDER))


#: Where fewer than one in so many of a batch's records are picked, the others are dropped unshuffled.
_FEW = 2


def _pick(batch: DataFrame, keys: DataFrame, winners: DataFrame) -> DataFrame:
    """The batch's rows with the winners' identities, one row each.

    Repeats of a record go before the shuffle that the join shares.  In a batch that brings
    little new, so do the records that are not picked.
    """
    marks = keys.select(F.lit(0).alias("_won")).union(winners.select(F.lit(1)))
    picked, both = marks.agg(F.coalesce(F.sum("_won"), F.lit(0)), F.count("_won")).first()
    if not picked:
        return batch.limit(0)
    if picked * _FEW < both - picked:
        _, batch = by_membership(batch, F.col("content_hash"), winners.select(F.col("content_hash").alias("_key")))
    identities = winners.select(*_IDENTITY)
    return first_per_key(batch, _IDENTITY, ["timestamp"]).join(identities, _IDENTITY, "left_semi")


def insert_ignore(batch: DataFrame, table: DataFrame | Lookup) -> tuple[DataFrame, DataFrame]:
    """Split a batch into rows to insert and rows that clash.

    ``table`` has ``content_hash`` and ``event_id``, or is a function that looks stored
    keys of one of these names up.  Content that is taken --
    by the table or by an earlier row of the batch -- is dropped without notice.
    A row that brings new content under a taken id is a clash: it is returned
    as such, never stored and never lost.

    The decision is made on (event_id, content_hash, timestamp) alone; then the
    wide rows to insert are shuffled once, after repeats of the same record have
    been dropped in the map tasks, and of the others the clashes alone.  Of a batch that
    is known for the most part, only a little more than what is new is shuffled.
    """
    keys = stored(batch.groupBy(*_IDENTITY).agg(F.min("timestamp").alias("timestamp")), "keys")
    look_up = table if callable(table) else partial(present, table)
    seen = look_up(keys, "content_hash")
    taken = look_up(keys, "event_id").withColumn("_taken", F.lit(True))
    fresh = (
        keys.join(seen, "content_hash", "left_anti")
        .join(taken, "event_id", "left")
        .select(*_ORDER, F.coalesce("_taken", F.lit(False)).alias("_taken"))
    )
    fresh = stored(fresh, "fresh")
    winners = stored(_settle(fresh.where(~F.col("_taken")).drop("_taken")), "winners")
    # What is left is a copy if an earlier row brought its content in, else a
    # clash: its id was taken before it came.
    brought = winners.select("content_hash", F.struct("timestamp", "event_id").alias("_by"))
    others = fresh.join(winners.select(*_IDENTITY), _IDENTITY, "left_anti")
    clashing = others.join(brought, "content_hash", "left").where(
        F.col("_by").isNull() | (F.struct("timestamp", "event_id") < F.col("_by"))
    )
    inserts = _pick(batch, keys, winners)
    # Clashes are few as a rule: their rows are picked out before anything wide is shuffled.
    clashing = stored(clashing.select(*_IDENTITY), "clashing")
    clashes = first_per_key(batch.join(clashing, _IDENTITY, "left_semi"), _IDENTITY, ["timestamp"])
    return inserts.select(*batch.columns), clashes.select(*batch.columns)
