"""Quality rules by repetition coverage.

Rolling hashes of word n-grams of several lengths mark every word inside an
n-gram that the text holds twice or more; the share of a text's characters under
the marks, for each length and for repeated lines, is held against a limit.  All
of a text is measured, in one row, in numpy.

Null text is an empty one: no words, and rejected as too short.  Repeated rows
are judged each on their own, a null id stays null, further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from newsmart.llm.common import text_of
from newsmart.llm.words import covered, hashes, repeated, spans, window_hashes

#: Words of the windows of the base rule.
BASE_WINDOW = 8
#: Largest share of characters inside repeated n-grams of so many words, ascending.
#: About three times MassiveText's, since a line that a short text repeats is no fault.
NGRAM_LIMITS = {5: 0.45, 6: 0.42, 7: 0.39, 8: 0.36, 9: 0.33, 10: 0.30}
#: The same for repeated lines, and for words that stand directly beside their like.
LINE_LIMIT = 0.30
STUTTER_LIMIT = 0.10
#: Symbols to words.
SYMBOL_LIMIT = 0.10
#: Share of capitals among the letters of A-Z.
CAPITAL_LIMIT = 0.5

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, line_share double, stutter_share double, capital_share double, "
    + ", ".join(f"share_{n} double" for n in NGRAM_LIMITS)
)


def _chars(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code points of each word."""
    seen = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    return seen[ends] - seen[starts]


def _lines(data: bytes, buf: np.ndarray) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and their characters."""
    seen: set[bytes] = set()
    n = chars = 0
    for line in data.split(b"\n"):
        if line in seen:
            n += 1
            chars += len(line.decode())
        elif line.split():
            seen.add(line)
    return n, chars


def measure(text: object) -> tuple:
    """All columns after doc_id, for one text."""
    data = text_of(text).encode()
    buf = np.frombuffer(data, np.uint8)
    starts, ends = spans(data)
    words, chars = hashes(data), _chars(buf, starts, ends)
    n, total = len(words), int(chars.sum())
    symbols = int(_SYMBOLS[buf].sum())
    dup_lines, dup_chars = _lines(data, buf)

    share: dict[int, float] = dict.fromkeys(NGRAM_LIMITS, 0.0)
    repeats = 0
    for k in sorted({BASE_WINDOW, *NGRAM_LIMITS}):
        marks = covered(repeated(window_hashes(words, k)), k)
        if not marks.any():  # then no longer n-gram is repeated
            break
        if k == BASE_WINDOW:
            repeats = int(marks.sum())
        if k in share:
            share[k] = float(chars[marks].sum()) / total
    beside = np.zeros(n, bool)
    if n > 1:
        beside[1:] = words[1:] == words[:-1]
    stutter = float(chars[beside].sum()) / total if total else 0.0
    lines = dup_chars / max(len(text_of(text)), 1)
    upper = int(((buf >= 65) & (buf <= 90)).sum())
    capitals = upper / max(upper + int(((buf >= 97) & (buf <= 122)).sum()), 1)
    failed = n < 20 or 100 * repeats > 30 * n
    kept = (
        not failed
        and all(share[k] <= limit for k, limit in NGRAM_LIMITS.items())
        and lines <= LINE_LIMIT
        and stutter <= STUTTER_LIMIT
        and symbols <= SYMBOL_LIMIT * n
        and capitals <= CAPITAL_LIMIT
    )
    return (n, total, symbols, dup_lines, repeats, failed, kept, lines, stutter, capitals, *share.values())


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: the measures, ``base_failed`` and ``kept``."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [measure(text) for text in batch["text"]]
            out = pd.DataFrame(rows, columns=names[1:])
            out.insert(0, "doc_id", pd.array(batch["doc_id"], dtype="Int64"))
            yield out

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInPandas(run, SCHEMA)
