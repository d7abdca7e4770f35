"""Text: hashing, watch-list terms, prompts and model replies."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from newsmart.schemas import PROMPT_CONTENT_CHARS

# A word is a run of letters, digits (of any script) and underscores.
_WORD = r"[\p{L}\p{N}_]"
_NON_WORD = r"[^\p{L}\p{N}_]+"


def content_hash(content: Column) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 text."""
    return F.sha2(content, 256)


def _is_word(term: str) -> bool:
    return re.fullmatch(r"\w+", term) is not None


def _bounded(term: str) -> str:
    """Pattern for ``term`` with a word boundary at both ends."""

    def edge(char: str, behind: bool) -> str:
        look = "?<" if behind else "?"
        sign = "!" if _is_word(char) else "="
        return f"({look}{sign}{_WORD})"

    return edge(term[0], True) + r"\Q" + term + r"\E" + edge(term[-1], False)


def extract_terms(text: Column, terms: Sequence[str]) -> Column:
    """Terms of the list that occur in ``text`` as whole words, in list order.

    Matching ignores case.  Terms made of word characters share one pass over
    the text, which is cut into words; a term with other characters (``BRK.B``)
    may overlap them and gets a pass of its own.
    """
    terms = list(dict.fromkeys(t.upper() for t in terms if t))
    if not terms:
        return F.array().cast("array<string>")
    upper = F.upper(text)
    words = [t for t in terms if _is_word(t)]
    found = F.split(upper, _NON_WORD) if words else F.array().cast("array<string>")
    others = [F.when(upper.rlike(_bounded(t)), F.lit(t)) for t in terms if not _is_word(t)]
    if others:
        found = F.concat(found, F.array_compact(F.array(*others)))
    return F.array_intersect(F.array(*map(F.lit, terms)), found)


def routing_key(tickers: Column, default: str) -> Column:
    """First ticker, or ``default`` where there is none."""
    return F.coalesce(F.get(tickers, F.lit(0)), F.lit(default))


def render_prompt(title: Column, content: Column, max_chars: int = PROMPT_CONTENT_CHARS) -> Column:
    """Prompt for one article; the content is cut to the model's budget."""
    return F.concat(
        F.lit("Title: "), title, F.lit("\n\nContent: "), F.substring(content, 1, max_chars)
    )


def unfence_json(reply: Column) -> Column:
    """Body of the first fenced block if there is one, else the whole reply."""
    # Up to the opening fence and from the closing one on, if both are there.
    opened = F.instr(reply, "```")
    rest = F.regexp_replace(F.substr(reply, opened + 3), r"\A(json)?", "")
    closed = F.instr(rest, "```")
    fenced = (opened > 0) & (closed > 0)
    body = F.when(fenced, F.substr(rest, F.lit(1), closed - 1)).otherwise(reply)
    return F.regexp_replace(body, r"^\s+|\s+$", "")
