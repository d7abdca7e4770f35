"""Quality classifier with hierarchical empirical Bayes.

A document's own evidence comes from two logistic models (good against bad, toxic
against clean) over measures of its whole text and over marker words, both learned
from at most ``TRAIN_ROWS`` labelled documents, chosen by the hash of their id; near
copies among them count once for the markers.

Grouped sums over all documents then give each host, and each path within its
host, a beta posterior of its share of good documents.  The host's prior is the
global share, the path's prior its host's posterior; the strength of either prior
is estimated from the spread between groups (method of moments), so a site of a few
documents stays near the prior and a large one speaks for itself.  A document is
left out of its own groups' sums.  The document's log odds and the shift of its path's
posterior from the global share are added.

Only measures and sums travel: a host with a third of all documents reaches its
reducer as one row per task.  ``source`` holds the host and, after a slash, the
path; ``lang`` ends the path.  Null hosts and languages are groups of their own,
null text is an empty one and rejected, null ids are kept, repeated rows are judged
alike, repeated labels count at their worst, further columns are ignored.  Without
usable labels of both kinds a model says nothing and the share alone decides.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, Window, functions as F

from newsmart.llm.common import row_key, stored, text_of
from newsmart.llm.words import covered, hashes, repeated, spans, window_hashes

#: Labelled documents to learn from, at most.
TRAIN_ROWS = 10_000
#: Marker words per model, the documents that must hold one, and the least z score.
MARKERS, MARKER_ROWS, MARKER_Z = 1000, 5, 4.0
#: Largest strength of a prior, in documents.
MAX_STRENGTH = 1e6
RIDGE = 1.0
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>{}[]\\^~=_@")] = True
_PLAIN = str.maketrans(string.punctuation, " " * len(string.punctuation))
#: Letters of a word's beginning, which stands for its forms.
STEM = 4
N_MEASURES = 10


def marker_words(text: str) -> set[str]:
    """Words in lower case without ASCII punctuation, and beginnings of longer ones."""
    words = set(text.lower().translate(_PLAIN).split())
    return words | {w[:STEM] + "*" for w in words if len(w) > STEM + 1}


def measures(text: str) -> list[float]:
    """Shares that tell prose from junk, each within 0 and about 1."""
    data = text.encode()
    buf = np.frombuffer(data, np.uint8)
    words = hashes(data)
    n = len(words)
    if not n:
        return [0.0] * N_MEASURES
    starts, ends = spans(data)
    upper, lower = ((buf >= 65) & (buf <= 90)).sum(), ((buf >= 97) & (buf <= 122)).sum()
    same = covered(repeated(window_hashes(words, 5)), 5)
    lines = [x for x in data.split(b"\n") if x.split()]
    return [
        float(np.log1p(n) / 10),
        float(_SYMBOLS[buf].sum() / n),
        float(upper / max(upper + lower, 1)),
        float(len(np.unique(words)) / n),
        float(same.sum() / n),
        float((words[1:] == words[:-1]).sum() / n),
        float((ends - starts == 1).sum() / n),
        1 - len(set(lines)) / max(len(lines), 1),
        float((ends - starts).mean() / 10),
        float(((buf >= 48) & (buf <= 57)).sum() / len(buf)),
    ]


def signature(text: str) -> int:
    """A hash that near copies mostly share: the least of their shingles'."""
    words = hashes(text.encode())
    shingles = window_hashes(words, min(5, max(len(words), 1)))
    return int(shingles.min().view(np.int64)) if len(shingles) else 0


@dataclass(frozen=True)
class Model:
    """Marker words with their weights, and a logistic model over measures and evidence."""

    markers: dict[str, float]
    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray

    def evidence(self, found: set[str]) -> list[float]:
        held = [self.markers[w] for w in found & self.markers.keys()]
        return [sum(held) / 10, max(held, default=0.0) / 10, float(np.log1p(len(held)))]

    def log_odds(self, measured: list[float], found: set[str]) -> float:
        x = (np.array([*measured, *self.evidence(found)]) - self.mean) / self.scale
        return float(np.clip(self.beta[0] + x @ self.beta[1:], -12, 12))


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton's method, on standardised columns."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    a = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    beta = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], RIDGE)
    penalty[0] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        step = np.linalg.solve(
            (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty), a.T @ (y - p) - penalty * beta
        )
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, beta


def _nothing() -> Model:
    width = N_MEASURES + 3
    return Model({}, np.zeros(width), np.ones(width), np.zeros(width + 1))


def _top_markers(examples: DataFrame, target: str) -> list[Row]:
    """Words that stand out in rows of ``target``; near copies of one label count once."""
    once = examples.dropDuplicates(["signature", target])
    totals = once.agg(F.sum(target).alias("hit"), F.count("*").alias("n")).first()
    hit, miss = float(totals["hit"] or 0), float((totals["n"] or 0) - (totals["hit"] or 0))
    if not hit or not miss:
        return []
    counts = once.select(target, F.explode("words").alias("word")).groupBy("word").agg(
        F.sum(target).cast("double").alias("a"), F.sum(1 - F.col(target)).cast("double").alias("b")
    )
    odds = F.log((F.col("a") + 0.5) / (hit - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (miss - F.col("b") + 0.5))
    z = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    ranked = counts.where(F.col("a") >= MARKER_ROWS).select("word", odds.alias("weight"), z.alias("z"))
    return ranked.where(F.col("z") > MARKER_Z).orderBy(F.desc("z"), "word").limit(MARKERS).collect()


def train(docs: DataFrame, labels: DataFrame) -> tuple[Model, Model]:
    """Models for bad and for toxic; labels are doc_id, quality (0 or 1), toxic (0 or 1)."""
    sample = (
        labels.where("doc_id is not null and quality is not null and toxic is not null")
        .groupBy("doc_id")
        .agg((1 - F.min("quality")).cast("int").alias("bad"), F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_ROWS)
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text_of(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "bad": batch["bad"],
                    "toxic": batch["toxic"],
                    "signature": [signature(t) for t in texts],
                    "measures": [measures(t) for t in texts],
                    "words": [sorted(marker_words(t)) for t in texts],
                }
            )

    # The sample has TRAIN_ROWS ids at most, some 200 KB; of rows that share an id one is an example.
    chosen = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text")).join(
        F.broadcast(sample), "doc_id"
    )
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text"))
    one = chosen.withColumn("nth", nth).where("nth = 1")
    examples = stored(
        one.select("text", "bad", "toxic").mapInPandas(
            run, "bad int, toxic int, signature long, measures array<double>, words array<string>"
        ),
        "quality-examples",
    )
    return _train(examples, "bad"), _train(examples, "toxic")


def _train(examples: DataFrame, target: str) -> Model:
    found = _top_markers(examples, target)
    if not found and not examples.where(F.col(target) == 1).head(1) or not examples.where(F.col(target) == 0).head(1):
        return _nothing()
    markers = {r["word"]: r["weight"] for r in found}
    listed = F.array(*[F.lit(w) for w in markers]) if markers else F.array().cast("array<string>")
    rows = examples.select(target, "measures", F.array_intersect("words", listed).alias("held")).toPandas()
    bare = Model(markers, np.zeros(0), np.zeros(0), np.zeros(0))
    x = np.array([[*m, *bare.evidence(set(h))] for m, h in zip(rows["measures"], rows["held"], strict=True)])
    return Model(markers, *_fit(x, rows[target].to_numpy(float)))


def _logit(p: object) -> object:
    return F.log(p / (1 - p))


def score(docs: DataFrame, bad: Model, toxic: Model) -> DataFrame:
    """doc_id, host, path and the document's own chances, in millionths."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in map(text_of, batch["text"]):
                m, w = measures(text), marker_words(text)
                if not text.split():
                    rows.append((0.0, 0.0))
                    continue
                rows.append(tuple(1 / (1 + np.exp(x.log_odds(m, w))) for x in (bad, toxic)))
            out = batch[["doc_id", "host", "path"]].copy()
            out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
            out[["good", "clean"]] = np.round(np.array(rows).reshape(-1, 2) * 1e6).astype(np.int64)
            yield out

    host = F.substring_index(F.coalesce(F.col("source").cast("string"), F.lit("")), "/", 1)
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        host.alias("host"),
        F.concat_ws("/", F.coalesce(F.col("source").cast("string"), F.lit("")), F.coalesce(F.col("lang").cast("string"), F.lit(""))).alias("path"),
        F.col("text").cast("string").alias("text"),
    )
    return chosen.mapInPandas(run, "doc_id long, host string, path string, good long, clean long")


def _strength(groups: DataFrame, prior: str) -> float:
    """Documents that the prior is worth: the spread of group means beyond chance."""
    n, mean, mu = F.col("n"), F.col("s") / F.col("n"), F.col(prior)
    spread = groups.where("n > 1").agg(
        F.sum(n * (mean - mu) * (mean - mu)).alias("between"),
        F.sum(mu * (1 - mu)).alias("chance"),
        F.sum(n).alias("n"),
        F.sum(n * mu * (1 - mu)).alias("whole"),
        F.count("*").alias("groups"),
    ).first()
    if not spread["groups"] or spread["groups"] < 2 or not spread["n"]:
        return MAX_STRENGTH
    tau = max(spread["between"] - spread["chance"], 0.0) / spread["n"]
    variance = spread["whole"] / spread["n"]
    return min(max(variance / tau - 1, 1.0), MAX_STRENGTH) if tau > 0 else MAX_STRENGTH


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, host, path, quality and toxicity of the document, site shift, and ``kept``."""
    return _judged(score(docs, *train(docs, labels)))


def _judged(scores: DataFrame) -> DataFrame:
    own = stored(scores, "quality-scores")
    p = F.col("good") / 1e6 * (F.col("clean") / 1e6)
    own = own.withColumn("p", F.round(p * 1e6).cast("long"))
    paths = stored(own.groupBy("host", "path").agg(F.sum("p").alias("sum"), F.count("*").alias("n")), "quality-paths")
    totals = paths.agg(F.sum("sum").alias("sum"), F.sum("n").alias("n")).first()
    mu = min(max((totals["sum"] or 0) / 1e6 / max(totals["n"] or 0, 1), 1e-3), 1 - 1e-3)
    hosts = paths.groupBy("host").agg(F.sum("sum").alias("host_sum"), F.sum("n").alias("host_n"))
    weight = _strength(
        hosts.select((F.col("host_sum") / 1e6).alias("s"), F.col("host_n").alias("n"), F.lit(mu).alias("mu")), "mu"
    )
    both = paths.join(hosts, "host").withColumn(
        "prior", (weight * mu + F.col("host_sum") / 1e6) / (weight + F.col("host_n"))
    )
    deep = _strength(both.select((F.col("sum") / 1e6).alias("s"), "n", "prior"), "prior")
    one = F.col("p") / 1e6
    # The sums without the document itself.
    host_post = (weight * mu + F.col("host_sum") / 1e6 - one) / (weight + F.col("host_n") - 1)
    path_post = (deep * host_post + F.col("sum") / 1e6 - one) / (deep + F.col("n") - 1)
    bounded = F.least(F.greatest(path_post, F.lit(1e-3)), F.lit(1 - 1e-3))
    inside = F.least(F.greatest(one, F.lit(1e-6)), F.lit(1 - 1e-6))
    joined = own.join(both.drop("prior"), ["host", "path"])
    shift = _logit(bounded) - F.log(F.lit(mu / (1 - mu)))
    return joined.select(
        "doc_id",
        "host",
        "path",
        (F.col("good") / 1e6).alias("quality"),
        (1 - F.col("clean") / 1e6).alias("toxicity"),
        shift.alias("site_shift"),
        ((_logit(inside) + shift >= 0) & (F.col("clean") >= 500_000)).alias("kept"),
    )


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows the classifier rejects; all columns stay."""
    key = row_key(docs, "source", "lang")
    rows = docs.select(key.alias("doc_id"), docs["text"], docs["source"], docs["lang"])
    verdicts = _judged(score(rows, *train(docs, labels)))
    bad = stored(verdicts.where("not kept").select(F.col("doc_id").alias("_bad")).distinct(), "rejected")
    return docs.join(bad, key == bad["_bad"], "left_anti")
