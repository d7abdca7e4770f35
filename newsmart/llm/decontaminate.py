"""Benchmark decontamination by spaced seeds.

Words are compared in lower case without ASCII punctuation; in scripts written without
spaces (Chinese, Japanese, Thai, Lao, Burmese, Khmer) each character is a word.  A document holds an
item if, at some shift, ``WINDOW`` words in a row agree with words of the item but for
``ERRORS`` substitutions at most; for an item of fewer words the whole of it must
agree, with errors in proportion.  Items of under ``LEAST`` words are no evidence.

Fixed masks hash some places of a window of words and ignore the others.  Each
family of masks hits every window of its length under every choice of so many
substitutions (the tests try all), so the search misses nothing.  The hashes of the
benchmark and of the documents are joined, and the words around each hit are then
compared one by one.

Documents are hashed where they are read.  A Bloom filter of the benchmark's
hashes, at most 16 MB, keeps what cannot match out of the shuffle; the join decides
after it.  Hits close together travel as one run with its words, so a benchmark
passage that a third of all documents hold costs each of them one short row.

Null text holds nothing; repeated items of the same words count as the one with
the smallest id, repeated documents as one; a null id is kept; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from newsmart.llm.common import Bloom, bloom_of, row_key, stored, text_of
from newsmart.llm.words import hashes, masked_hashes, spans

WINDOW, ERRORS, LEAST = 16, 3, 3
#: Items from so many words on use these masks (1: the word counts); fixed values.
FAMILIES = {
    16: ("1110010111", "11110111", "11010000010111", "1001111011"),
    11: ("1110111", "110100111", "1111101", "111111"),
    6: ("1111", "11011"),
    5: ("11111",),
    4: ("1111",),
    3: ("111",),
}
#: Bytes of texts that are hashed at once.
TOGETHER = 1 << 18
#: Characters that are words of their own, and the punctuation between them.
_UNSPACED = re.compile(
    "[\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]"
)
_MARKS = re.compile("[\u3000-\u303f\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")
_PLAIN = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def places(mask: str) -> tuple[int, ...]:
    return tuple(i for i, c in enumerate(mask) if c == "1")


def allowed(n_words: int) -> tuple[int, int]:
    """Length of the window that must agree, and the substitutions it may hold."""
    window = min(n_words, WINDOW)
    return window, window * ERRORS // WINDOW


def family(n_words: int) -> int:
    return next((least for least in FAMILIES if n_words >= least), 0)


def _plain(text: object) -> bytes:
    plain = text_of(text).lower()
    if not plain.isascii() and (_UNSPACED.search(plain) or _MARKS.search(plain)):
        plain = _UNSPACED.sub(r" \g<0> ", _MARKS.sub(" ", plain))
    return plain.encode().translate(_PLAIN)


def words(text: object) -> np.ndarray:
    return hashes(_plain(text))


def _together(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Neighbours of about ``TOGETHER`` bytes, with the number of the first."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= TOGETHER:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def items(benchmark: DataFrame) -> DataFrame:
    """item_id, words: one row for each sequence of words, under its smallest id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {
                    "item_id": pd.array(batch["item_id"], dtype="Int64"),
                    "words": [_signed(words(t)) for t in batch["text"]],
                }
            )

    chosen = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"])
    found = chosen.mapInPandas(run, "item_id long, words array<long>").where(F.size("words") >= LEAST)
    once = found.groupBy("words").agg(F.min("item_id").alias("item_id"))
    return once.select("item_id", "words", F.xxhash64("words").alias("item"))


def seeds(listed: DataFrame) -> DataFrame:
    """hash, item, place of every masked window of every item."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for item, own in zip(batch["item"], batch["words"], strict=True):
                own = np.asarray(own, np.int64).view(np.uint64)
                for mask in FAMILIES[family(len(own))]:
                    h = masked_hashes(own, places(mask))
                    parts.append(pd.DataFrame({"hash": _signed(h), "item": item, "place": np.arange(len(h))}))
            yield pd.concat(parts) if parts else pd.DataFrame({"hash": [], "item": [], "place": []})

    return listed.mapInPandas(run, "hash long, item long, place long")


def runs(docs: DataFrame, bloom: Bloom, masks: list[str]) -> DataFrame:
    """Stretches of documents that the filter lets through, with the words around them.

    first: place of the first of ``words`` in its document; hits: (hash, place).
    """
    around = WINDOW
    shared = docs.sparkSession.sparkContext.broadcast((bloom.log2, bloom.cells))

    def some(filter_: Bloom, texts: list[bytes]) -> Iterator[tuple]:
        """(number of the text, first, words, hashes, places) per run."""
        data = b"\n".join(texts)
        own = hashes(data)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        owner = np.searchsorted(begins, spans(data)[0], "right") - 1
        found = []
        for mask in masks:
            at_most = places(mask)
            h = _signed(masked_hashes(own, at_most))
            at = np.flatnonzero(filter_.holds(h))
            at = at[owner[at] == owner[at + at_most[-1]]]  # not across two texts
            found.append((h[at], at))
        h, at = (np.concatenate(x) for x in zip(*found, strict=True))
        if not len(at):
            return
        order = np.argsort(at, kind="stable")
        h, at = h[order], at[order]
        cuts = np.flatnonzero((np.diff(at) > 2 * around) | (np.diff(owner[at]) > 0)) + 1
        for hs, ps in zip(np.split(h, cuts), np.split(at, cuts), strict=True):
            text = int(owner[ps[0]])
            low, high = np.searchsorted(owner, [text, text + 1])
            first = max(int(low), int(ps[0]) - around)
            yield text, first - low, _signed(own[first : min(high, int(ps[-1]) + 2 * around)]), hs, ps - low

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filter_ = Bloom(*shared.value)
        for batch in batches:
            ids = pd.array(batch["doc_id"], dtype="Int64")
            rows = [
                (ids[start + text], *rest)
                for start, texts in _together([_plain(t) for t in batch["text"]])
                for text, *rest in some(filter_, texts)
            ]
            out = pd.DataFrame(rows, columns=["doc_id", "first", "words", "hashes", "places"])
            out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
            yield out

    schema = "doc_id long, first long, words array<long>, hashes array<long>, places array<long>"
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return chosen.mapInPandas(run, schema)


def _agreement(doc: np.ndarray, first: int, item: np.ndarray, shift: int) -> tuple[int, int] | None:
    """Words compared and words that agree, if some window agrees well enough."""
    window, errors = allowed(len(item))
    begin, end = max(first, shift), min(first + len(doc), shift + len(item))
    if end - begin < window:
        return None
    same = doc[begin - first : end - first] == item[begin - shift : end - shift]
    total = np.concatenate([[0], np.cumsum(same)])
    good = total[window:] - total[:-window] >= window - errors
    if not good.any():
        return None
    at = np.flatnonzero(good)
    low, high = int(at[0]), int(at[-1]) + window
    return high - low, int(total[high] - total[low])


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, first, doc, item_id, item, shift in zip(
            pd.array(batch["doc_id"], dtype="Int64"),
            batch["first"],
            batch["words"],
            pd.array(batch["item_id"], dtype="Int64"),
            batch["item_words"],
            batch["shift"],
            strict=True,
        ):
            if agreed := _agreement(np.asarray(doc), int(first), np.asarray(item), int(shift)):
                rows.append((doc_id, item_id, *agreed))
        out = pd.DataFrame(rows, columns=["doc_id", "item_id", "n_words", "n_equal"])
        for c in ("doc_id", "item_id"):
            out[c] = pd.array(out[c], dtype="Int64")
        yield out


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_words compared and n_equal: the longest overlap of each pair."""
    listed = stored(items(benchmark), "benchmark-items")
    planted = stored(seeds(listed), "benchmark-seeds")
    lengths = [r["n"] for r in listed.select(F.least(F.size("words"), F.lit(WINDOW)).alias("n")).distinct().collect()]
    masks = sorted({m for n in lengths for m in FAMILIES[family(n)]})
    if not masks:
        masks = list(FAMILIES[WINDOW])
    found = stored(
        runs(docs, bloom_of(planted, "hash"), masks).withColumn("run", F.monotonically_increasing_id()), "seed-runs"
    )
    hits = found.select("run", F.explode(F.arrays_zip("hashes", "places")).alias("hit")).select(
        "run", F.col("hit.hashes").alias("hash"), F.col("hit.places").alias("at")
    )
    shifts = hits.join(planted, "hash").select("run", "item", (F.col("at") - F.col("place")).alias("shift")).distinct()
    pairs = shifts.join(found.drop("hashes", "places"), "run").join(
        listed.select("item", "item_id", F.col("words").alias("item_words")), "item"
    )
    checked = pairs.select("doc_id", "first", "words", "item_id", "item_words", "shift").mapInPandas(
        _verify, "doc_id long, item_id long, n_words long, n_equal long"
    )
    best = F.max(F.struct("n_equal", "n_words")).alias("best")
    return checked.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.n_words", "best.n_equal")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay."""
    rows = docs.select(row_key(docs).alias("doc_id"), docs["text"])
    bad = stored(overlaps(rows, benchmark).select(F.col("doc_id").alias("_bad")).distinct(), "contaminated")
    return docs.join(bad, row_key(docs) == bad["_bad"], "left_anti")
