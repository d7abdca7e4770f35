from __future__ import annotations

import random
from math import comb

import numpy as np
import pytest

from newsmart.llm import jaccard as J
from newsmart.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute(rows):
    """doc_id -> smallest id by links; rows of one set are one node."""
    sets = [(d, frozenset(shingles(t))) for d, t in rows]
    least = {s: min((d for d, x in sets if x == s and d is not None), default=None) for _, s in sets}
    nodes = [s for s in least if s]
    part = {s: s for s in nodes}

    def find(s):
        while part[s] is not s:
            s = part[s]
        return s

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if 100 * len(a & b) >= 75 * len(a | b):
                part[find(a)] = find(b)
    root = {}
    for s in nodes:
        ids = [x for x in (root.get(find(s)), least[s]) if x is not None]
        root[find(s)] = min(ids, default=None)
    return sorted(((d, len(s), root[find(s)] if s else d) for d, s in sets), key=repr)


def corpus(seed, n=160):
    draw = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    common = " ".join(draw.choices(vocabulary, k=40))
    bases = [draw.choices(vocabulary, k=draw.choice([3, 5, 7, 9, 12, 14, 18, 22, 30, 60, 200])) for _ in range(25)]
    rows = []
    for i in range(n):
        words = list(draw.choice(bases))
        for _ in range(draw.choice([0, 0, 1, 1, 2, 4])):
            at = draw.randrange(len(words))
            words[at : at + draw.choice([0, 1])] = [draw.choice(vocabulary)]
        text = " ".join(words)
        if draw.random() < 0.3:
            text += "\n" + common
        rows.append((i, text.upper() if draw.random() < 0.2 else text))
    edge = [(900, None), (901, ""), (902, " \n"), (None, rows[0][1]), (903, rows[0][1]), (3, rows[3][1]), (None, "only null " * 9),
            (904, "a " * 30_000), (905, "A a a a a a"), (906, "É é"), (907, "é é"), (4, "another text of the same id as before, quite")]
    return rows + edge


@pytest.mark.parametrize("most", [0, 8, 16])
@pytest.mark.parametrize("block", [7, 1024])
def test_equals_brute_force(spark, documents, monkeypatch, most, block):
    monkeypatch.setattr(J, "boundary", lambda sizes: most)
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "SORTED", 3000)
    monkeypatch.setattr(J, "SENT", 1500)
    monkeypatch.setattr(J, "PART", 20)
    rows = corpus(most + block)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(documents(rows)).collect()), key=repr)
    assert got == brute(rows)


def test_keep_first_leaves_one_of_each(spark, documents):
    rows = [r for r in corpus(3) if r[0] is not None]
    frame = documents(rows)
    kept = J.keep_first(frame)
    assert kept.columns == frame.columns
    assert sorted({r.doc_id for r in kept.collect()}) == sorted({c for _, _, c in brute(rows)})


def test_empty_table(spark, documents):
    assert J.near_duplicates(documents([(1, "a")]).limit(0)).count() == 0
    got = J.near_duplicates(documents([(1, None), (2, "")])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(1, 0, 1), (2, 0, 2)]


def test_sizes():
    for n in range(1, 40):
        for m in range(1, 40):
            links = any(100 * c >= 75 * (n + m - c) for c in range(min(n, m) + 1))
            assert (m in J.partners(n, 40)) == links
            if links:
                assert J.least_shared(n, m) == min(c for c in range(min(n, m) + 1) if 100 * c >= 75 * (n + m - c))
    assert J.subsets(10, 10) == sum(comb(10, J.least_shared(10, m)) for m in (8, 9, 10))
    assert J.boundary({}) == 0
    assert J.boundary({4: 100, 5: 100}) >= 5
    assert J.boundary({16: 100}) < 16


def test_block_bytes_round_trip():
    values = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    assert (J._from_planes(J._planes(values), np.uint64) == values).all()


def test_components_of_a_chain(spark):
    ids = [hash((i, "x")) for i in range(300)]
    links = spark.createDataFrame([*zip(ids, ids[1:], strict=False), (1, 1), (ids[0], ids[1])], "u long, v long")
    got = components(links).collect()
    assert sorted(r.id for r in got) == sorted(ids)
    assert len({r.root for r in got}) == 1
