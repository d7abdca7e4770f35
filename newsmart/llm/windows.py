"""Order-preserving packing: where to cut a stream of tokens into windows.

Documents are tokenized, closed with an end id and laid one after the other in the
order of the table; each window becomes one training sequence.  Dynamic programming
over the places where a window may end chooses cuts that cost least in all:

* padding, ``capacity`` less the window's length, or nothing for a length that is a power
  of two, which is not padded;
* nothing for a cut between documents, ``SENTENCE`` for one between sentences, and
  ``WITHIN`` for one inside a sentence longer than a sixteenth of a sequence, which may be
  cut every ``GRID`` tokens: lists and junk without a full stop would else force padding.

The least cost up to a place is the least of (cost + place) over the places at most a
window before it, less its own place: a sliding minimum, kept in a monotone queue.
Lengths that are powers of two are looked up beside it.

Each task packs the documents it reads, in one pass, so nothing is shuffled, no
sequence spans two tasks, and a lost executor repeats a task on the same rows.
Ways to the last places soon share all their earlier cuts; those are written and
forgotten, so a task holds one batch and some windows, and the result is the same as over
all its documents at once.

Null text is an empty one: a piece of the end id alone.  Repeated rows are packed
each on its own, a null id is kept, further columns are ignored, an empty table
gives no piece.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from newsmart.llm.common import text_of

CAPACITY = 1024
END_ID = 0
#: Costs of a cut, in tokens of padding.
SENTENCE, WITHIN = 2, 8
#: Part of a sequence from which a sentence is long, and where it may be cut.
LONG, GRID = 16, 8

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_tokens long, ids binary"
)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_signs() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: itself, or the next one free."""
    own = {*range(33, 127), *range(161, 256)} - {173}
    free = iter(range(256, 512))
    return {chr(b if b in own else next(free)): b for b in range(256)}


#: How a byte-level tokenizer divides text before merging; a fixed value of that kind of tokenizer.
_DIVIDE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SENTENCE_END = re.compile(r"[.!?…。！？][\"'”’»)\]]*$|\n")
#: Beyond these letters two libraries may know other versions of Unicode.
_COMMON = re.compile(r"[^\u0000-ԯ֐-׿؀-ۿऀ-ॿ -⁯₠-₿぀-ヿ一-鿿가-힣＀-￯]")


class Vocabulary:
    """Ids of texts, and which ids end a sentence or begin with white space.

    A byte-level vocabulary's merges are applied by ``tiktoken``, five times as fast
    as ``tokenizers``, which gives the same ids and takes all other texts:
    those with special tokens or uncommon letters.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        words: dict[str, int] = made["model"]["vocab"]
        special = {t["content"]: t["id"] for t in made["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.fast = None
        pre = made["pre_tokenizer"] or {}
        signs = _byte_signs()
        level = pre.get("type") == "ByteLevel"
        shown = {
            i: bytes(signs[c] for c in w).decode(errors="replace") if level and set(w) <= signs.keys() else w
            for w, i in words.items()
        }
        if level and made["normalizer"] is None and pre["use_regex"] and not pre["add_prefix_space"]:
            import tiktoken

            ranks = {bytes(signs[c] for c in w): i for w, i in words.items() if w not in special}
            self.fast = tiktoken.Encoding("own", pat_str=_DIVIDE, mergeable_ranks=ranks, special_tokens={})
        size = max([*words.values(), *special.values()], default=0) + 1
        self.ends, self.newline, self.opens = (np.zeros(size, bool) for _ in range(3))
        for i, w in shown.items():
            self.newline[i] = "\n" in w
            self.ends[i] = bool(_SENTENCE_END.search(w))
            self.opens[i] = w[:1].isspace()

    def ids(self, text: str) -> np.ndarray:
        slow = self.fast is None or (self.special and self.special.search(text)) or _COMMON.search(text)
        found = self.tokenizer.encode(text, add_special_tokens=False).ids if slow else self.fast.encode_ordinary(text)
        return np.frombuffer(array("I", found), "<u4")

    def sentences(self, ids: np.ndarray) -> np.ndarray:
        """Places inside ids between two sentences."""
        before, after = ids[:-1], ids[1:]
        return np.flatnonzero(self.newline[before] | (self.ends[before] & self.opens[after])) + 1


_LOADED: dict[str, Vocabulary] = {}


def places(
    lengths: list[int], inner: list[np.ndarray], capacity: int = CAPACITY, first: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Where windows may end, and at which cost, for documents of these lengths laid out from ``first`` on.

    ``inner`` has per document the places between its sentences.
    """
    ends = first + np.cumsum(lengths)
    starts = ends - lengths
    at = np.concatenate([ends, *(s + x for s, x in zip(starts, inner, strict=True))]).astype(np.int64)
    cost = np.full(len(at), SENTENCE, np.int64)
    cost[: len(ends)] = 0
    order = np.argsort(at, kind="stable")
    at, cost = at[order], cost[order]
    gaps = np.diff(at, prepend=first)
    wide = np.flatnonzero(gaps > capacity // LONG)
    if len(wide):
        step = min(GRID, capacity // LONG)
        more = np.concatenate([np.arange(at[i] - gaps[i] + step, at[i], step) for i in wide])
        at = np.concatenate([at, more])
        cost = np.concatenate([cost, np.full(len(more), WITHIN, np.int64)])
        order = np.argsort(at, kind="stable")
        at, cost = at[order], cost[order]
    return at, cost


@dataclass
class Cuts:
    """Least-cost cuts of a stream whose places arrive bit by bit.

    ``at`` begins with the last cut that is decided; ``cost`` and ``back`` are each
    place's least cost and the place before it.
    """

    capacity: int = CAPACITY
    at: list[int] = field(default_factory=lambda: [0])
    cost: list[int] = field(default_factory=lambda: [0])
    back: list[int] = field(default_factory=lambda: [-1])

    def add(self, at: np.ndarray, penalty: np.ndarray) -> None:
        """Extend by further places, each at most ``capacity`` after the one before."""
        old, capacity = len(self.at), self.capacity
        whole = np.concatenate([np.array(self.at, np.int64), at])
        from_power, upto = self._powers(whole, old)
        place, cost, back = whole.tolist(), self.cost, self.back
        # Places by rising (cost + place), of which the first in reach is the best.
        queue: deque[int] = deque()
        key = [c + p for c, p in zip(cost, place)]
        for i in range(old):
            while queue and key[queue[-1]] >= key[i]:
                queue.pop()
            queue.append(i)
        a = 0
        for j, more, b in zip(range(old, len(place)), penalty.tolist(), upto, strict=True):
            p = place[j]
            far = p - capacity
            while place[queue[0]] < far:
                queue.popleft()
            chosen = queue[0]
            least = key[chosen] - far
            if a != b:
                for i in from_power[a:b]:
                    if cost[i] < least:
                        chosen, least = i, cost[i]
                a = b
            least += more
            cost.append(least)
            back.append(chosen)
            least += p
            key.append(least)
            while queue and key[queue[-1]] >= least:
                queue.pop()
            queue.append(j)
        self.at = place

    def _powers(self, at: np.ndarray, old: int) -> tuple[list[int], list[int]]:
        """The places a power of two before each new place, one after the other, and where each one's list ends."""
        base = int(at[0])
        index = np.full(int(at[-1]) - base + 1, -1, np.int64)
        index[at - base] = np.arange(len(at))
        found, size = [], 1
        while size < self.capacity:
            before = at[old:] - base - size
            found.append(np.where(before >= 0, index[np.maximum(before, 0)], -1))
            size *= 2
        table = np.stack(found, 1) if found else np.zeros((len(at) - old, 0), np.int64)
        hit = table >= 0
        return table[hit].tolist(), np.cumsum(hit.sum(1)).tolist()

    def decided(self, end: bool = False) -> list[int]:
        """Cuts that all ways to the last places share, now forgotten; at the end of the stream all of the best way's.

        The first one is where the last call left off.
        """
        n = len(self.at)
        live = {n - 1} if end else {i for i in range(n - 1, -1, -1) if self.at[i] > self.at[-1] - self.capacity}
        i = n - 1
        while len(live) > 1:
            while i not in live:
                i -= 1
            live.remove(i)
            live.add(max(self.back[i], 0))
        way = [live.pop()]
        while way[-1]:
            way.append(self.back[way[-1]])
        cuts = [self.at[i] for i in reversed(way)]
        keep = way[0]
        base = self.cost[keep]
        self.at = self.at[keep:]
        self.cost = [c - base for c in self.cost[keep:]]
        self.back = [-1, *(max(b - keep, 0) for b in self.back[keep + 1 :])]
        return cuts


@dataclass
class Stream:
    """The tokens of a task not yet written, by document."""

    capacity: int
    keep: bool
    task: int
    made: int = 0
    docs: list[tuple] = field(default_factory=list)  # id, start in the stream, length
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, "<u4"))
    first: int = 0

    def written(self, cuts: list[int]) -> list[tuple]:
        """Pieces of the windows between ``cuts``."""
        if len(cuts) < 2:
            return []
        begin, end = cuts[0], cuts[-1]
        starts = np.array([d[1] for d in self.docs], np.int64)
        ends = starts + np.array([d[2] for d in self.docs], np.int64)
        marks = np.unique(np.concatenate([cuts, ends[(ends > begin) & (ends < end)]]))
        doc = np.searchsorted(ends, marks[:-1], "right")
        window = np.searchsorted(cuts, marks[:-1], "right") - 1
        data = self.ids.tobytes()
        rows = []
        for a, b, d, w in zip(marks[:-1].tolist(), marks[1:].tolist(), doc.tolist(), window.tolist(), strict=True):
            doc_id, start, length = self.docs[d]
            part = data[4 * (a - self.first) : 4 * (b - self.first)]
            rows.append(
                (doc_id, a - start, b - a, zlib.crc32(part), length, (self.task << 33) + self.made + w, a - cuts[w])
                + (cuts[w + 1] - cuts[w], part if self.keep else None)
            )
        self.made += len(cuts) - 1
        left = int(np.searchsorted(ends, end, "right"))
        self.docs = self.docs[left:]
        self.ids = self.ids[end - self.first :].copy()
        self.first = end
        return rows


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, keep_ids: bool = False
) -> DataFrame:
    """Where each part of every document of ``docs`` (doc_id, text) goes, with its ids if asked for."""
    path = tokenizer or default_tokenizer()
    end = np.array([END_ID], "<u4")
    names = [c.split()[0] for c in PIECES.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _LOADED.get(path) or _LOADED.setdefault(path, Vocabulary(path))
        cuts, stream = Cuts(capacity), Stream(capacity, keep_ids, TaskContext.get().partitionId())
        total = 0
        for batch in batches:
            if not len(batch):
                continue
            ids = [words.ids(text_of(t)) for t in batch["text"]]
            lengths = [len(x) + 1 for x in ids]
            at, cost = places(lengths, [words.sentences(x) for x in ids], capacity, total)
            for doc_id, n in zip(pd.array(batch["doc_id"], dtype="Int64"), lengths, strict=True):
                stream.docs.append((doc_id, total, n))
                total += n
            stream.ids = np.concatenate([stream.ids, *(x for own in ids for x in (own, end))])
            cuts.add(at, cost)
            yield frame(stream.written(cuts.decided()))
        yield frame(stream.written(cuts.decided(end=True)))

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return chosen.mapInPandas(run, PIECES)


def packed(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Where each piece goes, and its sequence's length, without the ids."""
    return pieces(docs, capacity, tokenizer).drop("ids")


def sequences(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (array of int), padding."""

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A task writes its windows one after the other, in order.
        held: list[tuple[int, bytes]] = []

        def made(rows: list[tuple[int, bytes]]) -> tuple:
            ids = np.frombuffer(b"".join(x for _, x in rows), "<u4").astype(np.int32)
            n = len(ids)
            return rows[0][0], ids, 0 if n & (n - 1) == 0 else capacity - n

        for batch in batches:
            rows = []
            for own in zip(batch["sequence_id"].tolist(), batch["ids"], strict=True):
                if held and held[0][0] != own[0]:
                    rows.append(made(held))
                    held = []
                held.append(own)
            yield pd.DataFrame(rows, columns=["sequence_id", "ids", "padding"])
        if held:
            yield pd.DataFrame([made(held)], columns=["sequence_id", "ids", "padding"])

    parts = pieces(docs, capacity, tokenizer, keep_ids=True).select("sequence_id", "ids")
    return parts.mapInPandas(join, "sequence_id long, ids array<int>, padding long")
