"""Packing documents into training sequences by the sum-of-squares rule.

A document is tokenized and closed with an end id; one longer than a sequence is
cut.  Each piece goes into the open sequence, or a new one, for which the sum of
the squared counts of open sequences per residual gap becomes smallest; ties go
to the tightest fit.  Pieces are placed from the longest down, which the rule
allows as all are known.

Packing is spread over groups of about ``GROUP`` pieces each, dealt by a row
number and so even however many rows share an id; a group leaves a few sequences
partly open, some parts in a thousand of it.  Pieces are stored before they are
dealt, so a lost executor repeats a task on the same rows.

Null text is an empty one: a piece of the end id alone.  Repeated rows are packed
each on its own, a null id is kept, further columns are ignored, an empty table
gives no piece.
"""

from __future__ import annotations

import gc
import json
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from newsmart.llm.common import stored, text_of

CAPACITY = 4096
END_ID = 1
#: Pieces packed by one task.
GROUP = 16384
#: Words whose ids a task remembers, about 200 MB.
CACHE_WORDS = 1_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_signs() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself, or the next one free."""
    own = {*range(33, 127), *range(161, 256)} - {173}
    free = iter(range(256, 512))
    return {b: chr(b if b in own else next(free)) for b in range(256)}


_SIGNS = _byte_signs()


def _bare(tokenizer: object) -> object | None:
    """The vocabulary alone, for words of letters that its normalizer would not change."""
    from tokenizers import Tokenizer

    made = json.loads(tokenizer.to_str())
    steps = [x["type"] for x in (made["normalizer"] or {}).get("normalizers", [])]
    if steps != ["NFC", "Replace", "Lowercase"] or made["pre_tokenizer"]["pretokenizers"][-1]["type"] != "ByteLevel":
        return None
    return Tokenizer.from_str(
        json.dumps(made | {"normalizer": None, "pre_tokenizer": None, "post_processor": None, "added_tokens": []})
    )


#: Signs that end a word of letters as tokens of their own.
_STOPS = (b".", b",")


class WordIds:
    """Ids of whole texts from ids of words, each word tokenized once.

    Right for tokenizers that lower the case, drop white space and never join
    across it or from letters to other signs.  A text that may hold a special
    token is tokenized as it stands.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.cache = Tokenizer.from_file(path), {}
        self.bare = _bare(self.tokenizer)
        self.stop = {c: self._whole(c.decode()) for c in _STOPS}

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words not yet known; one that ends in a stop is its stem and the stop."""
        stops = [w for w in words if w[-1:] in _STOPS and w[-2:-1].isalpha()]
        stems = {w[:-1] for w in stops}
        missing = [w for w in words.difference(stops) | stems if w not in self.cache]
        own: dict[bytes, bytes] = {}
        for at in range(0, len(missing), 20_000):
            own |= self._encode(missing[at : at + 20_000])
        for w in stops:
            stem = w[:-1]
            own[w] = (own[stem] if stem in own else self.cache[stem]) + self.stop[w[-1:]]
        return own

    def _encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        if self.bare is None:
            return self._encoded(self.tokenizer, words, [w.decode() for w in words])
        plain, signs, rest = [], [], []
        for w in words:
            if w.isalpha():  # ASCII letters alone, in lower case already
                plain.append(w)
                signs.append(w.decode())
            elif (t := w.decode()).isalpha() and t.lower() == t and is_normalized("NFC", t):
                plain.append(w)
                signs.append(w.decode("latin-1").translate(_SIGNS))
            else:
                rest.append(w)
        return self._encoded(self.bare, plain, signs) | self._encoded(self.tokenizer, rest, [w.decode() for w in rest])

    @staticmethod
    def _encoded(tokenizer: object, words: list[bytes], texts: list[str]) -> dict[bytes, bytes]:
        if not words:
            return {}
        encoding = tokenizer.encode(texts, is_pretokenized=True, add_special_tokens=False)
        ids = np.asarray(encoding.ids, "<u4").tobytes()
        ends = np.searchsorted(np.asarray(encoding.word_ids, np.int64), np.arange(len(words)), "right")
        ends = (4 * ends).tolist()
        return {w: ids[a:b] for w, a, b in zip(words, [0, *ends[:-1]], ends, strict=True)}

    def batch(self, texts: list[str]) -> list[bytes]:
        """Per text its ids, little-endian unsigned 32-bit."""
        # Lists of many words hold no cycles, and collecting them takes a sixth of the time.
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._batch(texts)
        finally:
            if collecting:
                gc.enable()

    def _batch(self, texts: list[str]) -> list[bytes]:
        known = self.cache
        split = [[] if "<|" in t else t.encode().lower().split() for t in texts]
        new = self._learn(set().union(*split).difference(known))
        known.update(new)
        ids = known.__getitem__
        out = [self._whole(t) if "<|" in t else b"".join(map(ids, words)) for t, words in zip(texts, split, strict=True)]
        if len(known) > CACHE_WORDS:
            for w in new:
                del known[w]
        return out

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_LOADED: dict[str, WordIds] = {}


def cut(doc_id: object, ids: bytes, capacity: int, keep: bool) -> Iterator[tuple]:
    """Pieces of one document, its ids with the end id."""
    step = 4 * capacity
    for n, at in enumerate(range(0, len(ids), step)):
        part = ids[at : at + step]
        yield doc_id, n, at // 4, len(part) // 4, zlib.crc32(part), part if keep else None


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, keep_ids: bool = False
) -> DataFrame:
    """Tokenized pieces of ``docs`` (doc_id, text), with their ids if asked for."""
    path = tokenizer or default_tokenizer()
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _LOADED.get(path) or _LOADED.setdefault(path, WordIds(path))
        for batch in batches:
            ids = words.batch([text_of(t) for t in batch["text"]])
            rows = [
                row
                for doc_id, own in zip(pd.array(batch["doc_id"], dtype="Int64"), ids, strict=True)
                for row in cut(doc_id, own + end, capacity, keep_ids)
            ]
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
            out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
            yield out

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return chosen.mapInPandas(run, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, from the longest down."""
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by gap
    count = np.zeros(capacity + 1, np.int64)
    made = 0
    for i in order:
        size = int(lengths[i])
        # Squares of gap 0 do not count: that sequence is full.
        gaps = np.flatnonzero(count[size:]) + size
        gaps = gaps[gaps > 0]
        rest = gaps - size
        change = np.where(rest > 0, 2 * count[rest] + 1, 0) - 2 * count[gaps] + 1
        own = capacity - size
        if len(gaps) and (at := int(change.argmin())) >= 0 and change[at] <= (2 * count[own] + 1 if own else 0):
            gap = int(gaps[at])
            chosen = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, chosen, made = capacity, made, made + 1
        sequence[i], offset[i] = chosen, capacity - gap
        if gap > size:
            open_bins[gap - size].append(chosen)
            count[gap - size] += 1
    return sequence, offset


def pack(parts: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``parts`` (rows with a ``length`` of at most ``capacity``) with ``sequence_id`` and ``offset``.

    ``parts`` is read more than once and must give the same rows each time, as a
    stored table does.
    """
    groups = max(1, -(-parts.count() // group))
    names = parts.columns
    made = parts.schema.simpleString()[7:-1] + ",sequence_id:bigint,offset:bigint"

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sequence, offset = sum_of_squares(rows["length"].to_numpy(np.int64), capacity)
        out = rows[names].copy()
        out["sequence_id"], out["offset"] = sequence + (int(key[0]) << 32), offset
        return out

    dealt = parts.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(run, made)


def packed(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Where each piece of ``docs`` goes; the ids stay out of the shuffle."""
    parts = stored(pieces(docs, capacity, tokenizer).drop("ids"), "pieces")
    return pack(parts, capacity)


def sequences(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (array of int), at most ``capacity`` long."""
    parts = stored(pieces(docs, capacity, tokenizer, keep_ids=True), "pieces")
    placed = pack(parts, capacity)

    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        whole = b"".join(rows.sort_values("offset")["ids"])
        return pd.DataFrame({"sequence_id": [int(key[0])], "ids": [np.frombuffer(whole, "<u4").astype(np.int32)]})

    return placed.groupBy("sequence_id").applyInPandas(join, "sequence_id long, ids array<int>")
