"""Bulk annotation of articles by a model.

Prompts are built and replies parsed by Spark; Python sees prompts only, in
Arrow batches.  The model is a function the caller supplies.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from newsmart import schemas as S
from newsmart.functions.text import render_prompt, unfence_json
from newsmart.operators.validate import RecordRules, decode, once

# Workers get these functions with the job and need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Takes prompts, gives replies in the same order; None marks a failed article.
Complete = Callable[[pd.Series], Sequence[str | None]]

# What the model is told before each prompt; field names and labels are the reply's schema.
SYSTEM_PROMPT = f"""Read the financial news article below and reply with a single JSON object, without any
text or code fence around it. Its fields:
summary: what matters in the article, in two or three sentences.
sentiment: the label that fits best out of {", ".join(S.SENTIMENTS)}.
sentiment_confidence: how sure you are of the label, a number from 0.0 to 1.0.
entities: an array of objects with name, entity_type ({", ".join(S.ENTITY_TYPES)}) and
relevance_score (a number).
key_topics: three to five short topics."""

REPLY_RULES = RecordRules(
    schema=S.ANALYSIS_REPLY,
    required=("summary", "sentiment", "sentiment_confidence"),
    domains={"sentiment": S.SENTIMENTS},
    ranges={"sentiment_confidence": (0.0, 1.0)},
    numbers=("sentiment_confidence",),
    loose=("relevance_score",),
)

_ANSWER = "article_event_id string, reply string, error string"


def _in_halves(complete: Complete, prompts: pd.Series) -> tuple[list, list]:
    """Replies and errors; a call that fails is made again on either half of its prompts.

    A bad article costs the calls on its way down, not one for each neighbour.
    """
    try:
        replies = list(complete(prompts))
        if len(replies) != len(prompts):
            raise ValueError("model returned a different number of replies")
        return replies, ["no_reply" if r is None else None for r in replies]
    except Exception as failure:
        if len(prompts) == 1:  # the article is set aside, the batch goes on
            return [None], [f"model_error: {failure}"]
        middle = len(prompts) // 2
        left = _in_halves(complete, prompts.iloc[:middle])
        right = _in_halves(complete, prompts.iloc[middle:])
        return left[0] + right[0], left[1] + right[1]


def prompts_for(articles: DataFrame, max_chars: int = S.PROMPT_CONTENT_CHARS) -> DataFrame:
    """One (event_id, prompt) row per article."""
    prompt = render_prompt(F.col("title"), F.col("content"), max_chars)
    return articles.select("event_id", prompt.alias("prompt"))


def ask_model(
    prompts: DataFrame, make_complete: Callable[[], Complete], partitions: int | None = None
) -> DataFrame:
    """Raw replies for (event_id, prompt) rows: reply, or error.

    ``make_complete`` runs once per task and may open a client; it decides how a
    prompt is sent, usually after ``SYSTEM_PROMPT``.  A batch that
    fails is repeated in halves, so a failure costs one article.
    Model calls dominate, so ``partitions`` spreads articles evenly by id; the
    spread is by hash and comes out the same when a task is run again.

    Write the result to a table before using it twice: every reading of this
    frame calls the model.
    """
    if partitions:
        prompts = prompts.repartition(partitions, "event_id")

    def annotate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        complete = make_complete()
        for batch in batches:
            if not len(batch):
                continue
            replies, errors = _in_halves(complete, batch["prompt"])
            yield pd.DataFrame(
                {"article_event_id": batch["event_id"], "reply": replies, "error": errors}
            )

    return prompts.mapInPandas(annotate, _ANSWER)


def _entities(record: Column) -> Column:
    """Entities with the score as a number; null where one does not read."""
    return F.transform(
        record["entities"],
        lambda e: F.struct(
            e["name"].alias("name"),
            e["entity_type"].alias("entity_type"),
            e["relevance_score"].try_cast("double").alias("relevance_score"),
        ),
    )


def _written_null(name: str) -> Column:
    """True where the reply spells the field out as null; a missing one is fine."""
    field = F.try_variant_get(F.try_parse_json("value"), f"$.{name}", "variant")
    return F.coalesce(F.is_variant_null(field), F.lit(False))


def parse_replies(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored replies as (analyses, dead letters)."""
    answered = once(replies, unfence_json(F.coalesce("reply", F.lit(""))), "value")
    decoded = decode(answered, REPLY_RULES).withColumnRenamed("reasons", "_found")
    record = F.col("record")
    unscored = F.exists(
        F.coalesce(record["entities"], F.array()),
        lambda e: e["relevance_score"].isNotNull()
        & e["relevance_score"].try_cast("double").isNull(),
    )
    reasons = (
        F.when(F.col("error").isNotNull(), F.array("error"))
        .when(F.size("_found") > 0, F.col("_found"))
        .when(unscored, F.array(F.lit("number:entities")))
        .when(_written_null("entities"), F.array(F.lit("null:entities")))
        .when(_written_null("key_topics"), F.array(F.lit("null:key_topics")))
        .otherwise(F.col("_found"))
    )
    checked = once(decoded, reasons, "reasons")
    analyses = checked.where(F.size("reasons") == 0).select(
        "article_event_id",
        record["summary"].alias("summary"),
        record["sentiment"].alias("sentiment"),
        record["sentiment_confidence"].cast("double").alias("sentiment_confidence"),
        F.coalesce(_entities(record), F.array()).alias("entities"),
        F.coalesce(record["key_topics"], F.array()).alias("key_topics"),
        "analyzed_at",
        "model_id",
        "analysis_version",
    )
    dead = checked.where(F.size("reasons") > 0).select(
        "article_event_id", "reply", F.array_join("reasons", ",").alias("reason")
    )
    return analyses, dead
