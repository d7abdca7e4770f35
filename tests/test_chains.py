from __future__ import annotations

import random

import pytest

from newsmart.operators import chains

ORDER = ["timestamp", "event_id", "content_hash"]


def greedy(rows):
    contents, ids, won = set(), set(), []
    for content, event, at in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        if content not in contents and event not in ids:
            contents.add(content)
            ids.add(event)
            won.append((content, event, at))
    return sorted(won)


def resolved(spark, rows):
    frame = spark.createDataFrame(rows, "content_hash string, event_id string, timestamp long")
    return sorted(map(tuple, chains.resolve(frame, "content_hash", "event_id", ORDER).collect()))


@pytest.mark.parametrize(("n", "keys", "seed"), [(1, 1, 0), (30, 5, 1), (60, 12, 2), (400, 250, 3)])
def test_winners_are_those_of_taking_rows_one_by_one(spark, n, keys, seed):
    draw = random.Random(seed)
    pairs = {(f"c{draw.randrange(keys)}", f"e{draw.randrange(keys)}") for _ in range(n)}
    rows = [(c, e, draw.randrange(n)) for c, e in sorted(pairs)]
    assert resolved(spark, rows) == greedy(rows)


def test_a_chain_takes_a_logarithm_of_rounds(spark, monkeypatch):
    rounds = []

    def counted(frame, name, stored=chains.stored):
        rounds.append(name)
        return stored(frame, name)

    monkeypatch.setattr(chains, "stored", counted)
    for n in (256, 4096):
        rows = [(f"c{i // 2:06d}", f"e{(i + 1) // 2:06d}", i) for i in range(n)]
        rounds.clear()
        assert resolved(spark, rows) == greedy(rows)
        assert rounds.count("formulas") <= n.bit_length() + 3


def test_one_key_with_most_rows(spark):
    rows = [("hot", f"e{i:04d}", i + 1) for i in range(900)] + [("cold", "e0000", 0), ("cold", "e0005", 3)]
    assert resolved(spark, rows) == greedy(rows)


def test_no_rows(spark):
    assert resolved(spark, []) == []
