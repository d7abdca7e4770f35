from __future__ import annotations

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from newsmart.llm import queries, runs


def brute(words, least=runs.LEAST, power=runs.POWER):
    """All runs by trying every period at every place."""
    n, found = len(words), []

    def periodic(a, b, q):
        return all(words[i] == words[i + q] for i in range(a, b - q))

    for q in range(1, n // power + 1):
        a = 0
        while a < n - q:
            b = a
            while b < n - q and words[b] == words[b + q]:
                b += 1
            end = b + q
            if end - a >= max(least, power * q) and not any(periodic(a, end, p) for p in range(1, q)):
                found.append((a, end - a, q))
            a = max(b, a + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def of(words, **more):
    known = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return list(zip(*(x.tolist() for x in runs.find(np.array([known[w] for w in words], np.uint64), **more)), strict=True))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 9))
def test_runs_are_those_of_brute_force(words, least):
    assert of(words, least=least) == brute(words, least)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 7)), max_size=6),
)
def test_runs_of_powers_are_those_of_brute_force(parts):
    words = [w for part, times in parts for w in part * times]
    assert of(words) == brute(words)
    assert of(words, least=3) == brute(words, 3)


def test_power_below_three_is_refused():
    with pytest.raises(ValueError):
        runs.find(np.zeros(9, np.uint64), power=2)


CASES = [
    (1, " ".join("a b c".split() * 9)),
    (2, "one two three"),
    (3, None),
    (4, ""),
    (4, ""),
    (None, "x " * 30),
    (5, " \n\t ".join(["so"] * 24) + " end"),
    (6, "tail " + "p q " * 12 + "r " + "p q " * 12),
    (7, "w" * 100_000 + " " + "v " * 40),
    (8, " ".join(f"{i % 1000}" for i in range(30_000))),
]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words) if n < 5000 else [(0, 30_000, 1000)]
    drop = {i for s, k, q in found for i in range(s + q, s + k)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest(),
    )


def by_text(rows):
    return sorted(rows, key=str)


def test_summary_of_null_empty_repeated_and_long_texts(documents):
    made = runs.summary(documents(CASES), runs.planted).drop("n_words").collect()
    assert by_text(tuple(r) for r in made) == by_text(expected(*c) for c in CASES)


def test_query_over_a_whole_table(spark):
    """Every document of the smallest table, those with a planted tail included."""
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    short = {d for d, t in docs if len((t or "").split()) < 700}
    made = [tuple(r)[:-1] for r in queries.op13_basic_factor_runs(spark, sf).collect()]
    assert len(made) == len(docs)
    assert by_text(r for r in made if r[0] in short) == by_text(expected(*d) for d in docs if d[0] in short)
    assert sum(r[1] > 0 for r in made) >= len(docs) // 20


def test_runs_and_collapsed_texts(documents):
    docs = documents([(6, CASES[7][1]), (9, "a b"), (9, "a b"), (3, None)])
    assert sorted(map(tuple, runs.runs(docs).collect())) == [(6, 1, 24, 2, "p q"), (6, 26, 24, 2, "p q")]
    assert sorted(map(tuple, runs.collapse(docs).collect())) == [
        (3, "", 0), (6, "tail p q r p q", 44), (9, "a b", 0), (9, "a b", 0),
    ]


def test_empty_table(documents):
    empty = documents(CASES[:1]).where("doc_id < 0")
    assert runs.summary(empty).count() == runs.runs(empty).count() == runs.collapse(empty).count() == 0


def test_blocks_do_not_change_runs():
    import pandas as pd

    rows = pd.DataFrame({"doc_id": pd.array([c[0] for c in CASES], "Int64"), "text": [c[1] for c in CASES]})
    whole, small = ([runs._summary(*r) for part in runs.searched(iter([rows]), block=b) for r in part] for b in (1 << 18, 1))
    assert whole == small
