"""Periodic runs of words, by a dictionary of basic factors.

A run is a stretch of words with smallest period q, at least ``LEAST`` words and
``POWER`` periods long, that no neighbouring word extends.  For every length L = 1, 2,
4, ... all stretches of L words get a name, alike for alike stretches: a stretch
of 2L words is named by the names of its halves, and one that occurs once drops
out, so later lengths handle repeated places alone.  Where a stretch comes again
within twice its length, the distance d to its successor proposes period d; places in a
row with one distance form one arithmetic progression, which is extended word by word to
both sides.  Length L proposes the periods over L/2 and up to L: inside a run of
smallest period d a stretch of d words or more comes again at distance d and no
sooner, so each run is proposed once, with its smallest period.

Names carry the document, so many short texts are handled in one array and no
stretch matches in another document.  Nothing is shuffled.  Memory is a few
numbers per word of a block of ``BLOCK`` words, or of one longer document.

Null text has no words; an empty one has neither words nor runs.  Repeated rows give
repeated results, null ids are kept, further columns are ignored, an empty table gives no
rows.  Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from newsmart.llm.common import text_of
from newsmart.llm.words import hashes, mix

#: Words of a run at least, and periods.
LEAST, POWER = 24, 3
#: Words whose documents are searched together.
BLOCK = 1 << 18

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]
#: From an id and a number of words to the places of the words to search.
Places = Callable[[object, int], np.ndarray | None]


def _progressions(at: np.ndarray, gap: np.ndarray, size: int) -> Runs:
    """Start, end and period of stretches from places ``at`` whose successor is ``gap`` on."""
    order = np.lexsort((at, gap))
    at, gap = at[order], gap[order]
    new = np.ones(len(at), bool)
    new[1:] = (gap[1:] != gap[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return at[first], at[last] + gap[first] + size, gap[first]


def _extended(words: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
    """Move both ends outward while the period holds, in place."""
    grows = np.flatnonzero(start > 0)
    while len(grows := grows[start[grows] > 0]):
        before = start[grows] - 1
        grows = grows[words[before] == words[before + period[grows]]]
        start[grows] -= 1
    grows = np.arange(len(end))
    while len(grows := grows[end[grows] < len(words)]):
        after = end[grows]
        grows = grows[words[after] == words[after - period[grows]]]
        end[grows] += 1


def find(words: np.ndarray, least: int = LEAST, power: int = POWER) -> Runs:
    """Start, length and period of all runs of an array, by start, then period.

    ``power`` is 3 or more; only then does each run show its period at one length.
    """
    if power < 3:
        raise ValueError("power must be 3 or more")
    n = len(words)
    found: list[Runs] = []
    places, keys, size = np.arange(n), words, 1
    while len(places):
        order = np.argsort(keys, kind="stable")
        sorted_keys, sorted_at = keys[order], places[order]
        same = sorted_keys[1:] == sorted_keys[:-1]
        gap = sorted_at[1:] - sorted_at[:-1]
        near = same & (2 * gap > size) & (gap <= size)
        if near.any():
            start, end, period = _progressions(sorted_at[:-1][near], gap[near], size)
            _extended(words, start, end, period)
            long = end - start >= np.maximum(least, power * period)
            found.append((start[long], (end - start)[long], period[long]))
        # Names of the places whose stretch occurs again.
        again = np.zeros(len(order), bool)
        again[1:] |= same
        again[:-1] |= same
        name = np.cumsum(np.append(True, ~same))
        names = np.zeros(n, np.int64)
        names[sorted_at[again]] = name[again]
        places = np.sort(sorted_at[again])
        places = places[places + 2 * size <= n]
        second = names[places + size]
        places, second = places[second > 0], second[second > 0]
        keys = names[places] * (n + 1) + second
        size *= 2
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    runs = np.unique(np.stack([np.concatenate(x) for x in zip(*found, strict=True)], 1)[:, [0, 2, 1]], axis=0)
    return runs[:, 0], runs[:, 2], runs[:, 1]


def kept(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words are in no run after its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, start + period, 1)
    np.add.at(steps, start + length, -1)
    return np.cumsum(steps[:-1]) == 0


def _searched(rows: list[tuple[object, bytes, np.ndarray, np.ndarray | None]]) -> Iterator[tuple]:
    """id, words and runs of documents (id, text, hashes of its words, places or None), searched as one array."""
    own = [mix(h + np.uint64(2 * i + 1)) for i, (_, _, h, _) in enumerate(rows)]
    ends = np.cumsum([len(x) for x in own])
    start, length, period = find(np.concatenate(own))
    cuts = np.searchsorted(start, ends)
    a = 0
    for (doc_id, data, h, places), end, b in zip(rows, ends, cuts, strict=True):
        words = data.split()
        if places is not None:
            words = [words[i] for i in places.tolist()]
        yield doc_id, words, start[a:b] - (end - len(h)), length[a:b], period[a:b]
        a = b


def searched(
    batches: Iterator[pd.DataFrame], places: Places | None = None, block: int = BLOCK
) -> Iterator[list[tuple[object, list[bytes], np.ndarray, np.ndarray, np.ndarray]]]:
    """Per block of documents: id, words, and starts, lengths and periods of the runs.

    ``places`` may name, per document, which words in which order are searched.
    """
    for batch in batches:
        rows, size = [], 0
        for doc_id, text in zip(batch["doc_id"].array, batch["text"], strict=True):
            doc_id = None if pd.isna(doc_id) else doc_id
            data = text_of(text).encode()
            h = hashes(data)
            chosen = places(doc_id, len(h)) if places else None
            h = h if chosen is None else h[chosen]
            rows.append((doc_id, data, h, chosen))
            size += len(h)
            if size >= block:
                yield list(_searched(rows))
                rows, size = [], 0
        if rows:
            yield list(_searched(rows))


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    """Rows under a schema of longs and others, nulls kept."""
    fields = [c.rsplit(" ", 1) for c in schema.split(", ")]
    out = pd.DataFrame(rows, columns=[name for name, _ in fields])
    for name, kind in fields:
        if kind == "long":
            out[name] = pd.array(out[name], dtype="Int64")
    return out


def _chosen(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


RUN = "doc_id long, start long, length long, period long, words string"


def runs(docs: DataFrame) -> DataFrame:
    """Every run of every document, with the words of its first period."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for found in searched(batches):
            rows = [
                (doc_id, s, n, q, b" ".join(words[s : s + q]).decode())
                for doc_id, words, *own in found
                for s, n, q in zip(*(x.tolist() for x in own), strict=True)
            ]
            yield _frame(rows, RUN)

    return _chosen(docs).mapInPandas(work, RUN)


COLLAPSED = "doc_id long, text string, n_dropped long"


def collapse(docs: DataFrame) -> DataFrame:
    """Every document with each run cut down to its first period, words joined by one space."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for found in searched(batches):
            rows = []
            for doc_id, words, *own in found:
                stay = np.flatnonzero(kept(len(words), *own)).tolist()
                rows.append((doc_id, b" ".join([words[i] for i in stay]).decode(), len(words) - len(stay)))
            yield _frame(rows, COLLAPSED)

    return _chosen(docs).mapInPandas(work, COLLAPSED)


# --- the query's digest ---------------------------------------------------------

SUMMARY = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, n_words long"
)


def planted(doc_id: object, n: int) -> np.ndarray | None:
    """Every tenth id's text gets a periodic tail: the places of its words; a null id's stays."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def _summary(doc_id: object, words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple:
    stay = words
    if len(start):
        stay = [words[i] for i in np.flatnonzero(kept(len(words), start, length, period)).tolist()]
    own = list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
    best: tuple = (None, None, None, None)
    if own:
        s, n, q = min(own, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (s, n, q, 1000 * n // q)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in own)
    return (
        doc_id, len(own), *best, hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(b" ".join(stay)).hexdigest(), len(words),
    )


def summary(docs: DataFrame, places: Places | None = None) -> DataFrame:
    """Per document: number of runs, the strongest one, and digests of the runs and of the collapsed text."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for found in searched(batches, places):
            yield _frame([_summary(*row) for row in found], SUMMARY)

    return _chosen(docs).mapInPandas(work, SUMMARY)
