"""Serving tables.

Each batch owns a folder, ``batch_id=<writer>-<number>``, and writes it whole:
running a batch again replaces what the first attempt left behind.  A writer's
name must be its own; streams take the id that their checkpoint gives them, so
two streams, or one with a new checkpoint, never touch each other's batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from newsmart import schemas as S
from newsmart.functions.wire import encode
from newsmart.operators.references import (
    insert_ignore,
    orphan_analyses,
    valid_analyses,
)
from newsmart.operators.validate import (
    AGGREGATE_RULES,
    ANALYSIS_RULES,
    PROCESSED_RULES,
    RecordRules,
    accepted,
    decode,
    rejected,
)
from newsmart.session import stored
from newsmart.sinks.keys import merge_keys, write_keys
from newsmart.sources.keys import stored_keys
from newsmart.sources.tables import BATCH, read_table
from newsmart.sources.topics import topic_values

ARTICLES, AGGREGATES, ANALYSES, DEAD = (
    "articles",
    "ticker_aggregations",
    "llm_analyses",
    "dead_letters",
)


#: Columns that articles are looked up by.
ARTICLE_KEYS = ("content_hash", "event_id")


def write_batch(df: DataFrame, path: str, batch_id: str, lookup: str | None = None) -> None:
    """Write one batch; ``lookup`` names a column that is searched by value.

    That column gets Bloom filters, sized to its values, which let a search for
    an id skip the row groups without it.
    """
    writer = df.write.mode("overwrite")
    if lookup:
        writer = writer.options(
            **{
                f"parquet.bloom.filter.enabled#{lookup}": "true",
                "parquet.bloom.filter.adaptive.enabled": "true",
            }
        )
    writer.parquet(f"{path}/{BATCH}={batch_id}")


def _dead(rows: DataFrame, schema: T.StructType, topic: str, reason: str) -> DataFrame:
    return rows.select(
        F.lit(topic).alias("topic"), encode(schema).alias("value"), F.lit(reason).alias("reason")
    )


def write_articles(batch: DataFrame, root: str, batch_id: str) -> DataFrame:
    """Insert-ignore on content; returns the rows whose id was already taken."""
    path = f"{root}/{ARTICLES}"

    def look_up(wanted: DataFrame, key: str) -> DataFrame:
        return stored_keys(wanted, root, ARTICLES, S.PROCESSED_NEWS, key, [key], batch_id).distinct()

    inserts, clashes = insert_ignore(batch, look_up)
    write_batch(inserts, path, batch_id, lookup="event_id")
    written = read_table(batch.sparkSession, path, S.PROCESSED_NEWS, only=[batch_id])
    for key in ARTICLE_KEYS:
        write_keys(written, root, ARTICLES, batch_id, key, [key])
    return _dead(clashes, S.PROCESSED_NEWS, S.PROCESSED_TOPIC, "event_id_taken")


def write_aggregates(batch: DataFrame, root: str, batch_id: str) -> None:
    """Plain append; the batch folder makes a replay harmless."""
    write_batch(batch, f"{root}/{AGGREGATES}", batch_id)


_ANALYSIS_IDENTITY = ["article_event_id", "model_id", "analysis_version", "analyzed_at"]
# Tasks that one article's analyses are spread over.
SALTS = 16


def _known_articles(analyses: DataFrame, root: str) -> DataFrame:
    """Ids of the stored articles that analyses are of."""
    wanted = stored(analyses.select(F.col("article_event_id").alias("event_id")).distinct(), "wanted")
    found = stored_keys(wanted, root, ARTICLES, S.PROCESSED_NEWS, "event_id", ["event_id"])
    return stored(found.distinct(), "known")


def _store_analyses(analyses: DataFrame, root: str, batch_id: str) -> None:
    path = f"{root}/{ANALYSES}"
    write_batch(analyses, path, batch_id, lookup="article_event_id")
    written = read_table(analyses.sparkSession, path, S.ANALYSIS, only=[batch_id])
    write_keys(written, root, ANALYSES, batch_id, "article_event_id", _ANALYSIS_IDENTITY)


def _unstored(analyses: DataFrame, root: str, batch_id: str) -> DataFrame:
    """Analyses that no other batch has stored."""
    wanted = stored(analyses.select("article_event_id").distinct(), "wanted-articles")
    held = stored_keys(wanted, root, ANALYSES, S.ANALYSIS, "article_event_id", _ANALYSIS_IDENTITY, batch_id)
    held = held.select(*[F.col(c).alias(f"_{c}") for c in _ANALYSIS_IDENTITY])
    same = [analyses[c].eqNullSafe(held[f"_{c}"]) for c in _ANALYSIS_IDENTITY]
    return analyses.join(held, same, "left_anti")


def write_analyses(batch: DataFrame, root: str, batch_id: str) -> DataFrame:
    """Append the analyses whose article is stored; returns the others.

    An analysis that another batch has stored is not stored again.  One article's
    analyses are spread by salts, since a stream that keeps state is not re-planned.
    """
    known = _known_articles(batch, root)
    valid = _unstored(valid_analyses(batch, known, SALTS), root, batch_id)
    _store_analyses(valid, root, batch_id)
    orphans = orphan_analyses(batch, known, SALTS)
    return _dead(orphans, S.ANALYSIS, S.ANALYSIS_TOPIC, "no_such_article")


def retry_orphans(spark: SparkSession, root: str, batch_id: str) -> None:
    """Store the analyses that came before their article, now that it is there.

    Reads the dead letters; an analysis that has been stored is not stored
    again, so this can be run at any time.
    """
    dead = read_table(spark, f"{root}/{DEAD}", S.DEAD_LETTER).where("reason = 'no_such_article'")
    late = accepted(decode(dead, ANALYSIS_RULES), ANALYSIS_RULES)
    missing = _unstored(late, root, batch_id).dropDuplicates(_ANALYSIS_IDENTITY)
    found = valid_analyses(missing, _known_articles(missing, root))
    _store_analyses(found, root, batch_id)


def merge_indexes(spark: SparkSession, root: str) -> None:
    """Merge the key indexes' folders; run it now and then, no writer or reader need stop."""
    for key in ARTICLE_KEYS:
        merge_keys(spark, root, ARTICLES, S.PROCESSED_NEWS, key, [key])
    merge_keys(spark, root, ANALYSES, S.ANALYSIS, "article_event_id", _ANALYSIS_IDENTITY)


def write_topics(envelopes: DataFrame, root: str, batch_id: str) -> None:
    """One batch of mixed topic records into the three serving tables.

    Articles go first, so an analysis that arrives in the same batch finds its
    article.  Whatever cannot be stored goes to the dead letters with a reason.
    """
    batch = envelopes.persist()
    held = [batch]

    tasks = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def records(topic: str, rules: RecordRules, narrow: bool = True) -> tuple[DataFrame, DataFrame]:
        values = topic_values(batch, topic)
        if narrow:  # a topic of short records is a file or two, and so would be one task's
            values = values.repartition(tasks)
        # Read several times below; decoded once. An accepted record is not kept as written, too.
        decoded = decode(values, rules)
        decoded = decoded.withColumn("value", F.when(F.size("reasons") > 0, F.col("value"))).persist()
        held.append(decoded)
        return accepted(decoded, rules), rejected(decoded).select("topic", "value", "reason")

    try:
        news, bad_news = records(S.PROCESSED_TOPIC, PROCESSED_RULES, narrow=False)
        aggregates, bad_aggregates = records(S.AGGREGATION_TOPIC, AGGREGATE_RULES)
        analyses, bad_analyses = records(S.ANALYSIS_TOPIC, ANALYSIS_RULES)
        taken = write_articles(news, root, batch_id)
        write_aggregates(aggregates, root, batch_id)
        orphans = write_analyses(analyses, root, batch_id)
        known = [S.PROCESSED_TOPIC, S.AGGREGATION_TOPIC, S.ANALYSIS_TOPIC]
        other = batch.where(
            F.col("value").isNotNull() & ~F.coalesce(F.col("topic").isin(known), F.lit(False))
        ).select("topic", "value", F.lit("unknown_topic").alias("reason"))
        dead = taken.unionByName(orphans).unionByName(other)
        for bad in (bad_news, bad_aggregates, bad_analyses):
            dead = dead.unionByName(bad)
        write_batch(dead, f"{root}/{DEAD}", batch_id)
    finally:
        for frame in held:
            frame.unpersist()
