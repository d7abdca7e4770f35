from __future__ import annotations

import random
from itertools import combinations

import numpy as np

from newsmart.llm import decontaminate as D


def test_masks_miss_nothing():
    """Every family hits its shortest window under every choice of substitutions."""
    for least, masks in D.FAMILIES.items():
        longest = min([n - 1 for n in D.FAMILIES if n > least], default=least)
        window = min(least, D.WINDOW)
        errors = D.allowed(longest)[1]
        for wrong in combinations(range(window), errors):
            hit = any(
                not {p + shift for p in D.places(m)} & set(wrong)
                for m in masks
                for shift in range(window - D.places(m)[-1])
            )
            assert hit, (least, wrong)


def brute(doc, item):
    a, b = D.words(doc).tolist(), D.words(item).tolist()
    if len(b) < D.LEAST:
        return False
    window, errors = D.allowed(len(b))
    return any(
        sum(x != y for x, y in zip(a[i : i + window], b[j : j + window], strict=True)) <= errors
        for i in range(len(a) - window + 1)
        for j in range(len(b) - window + 1)
    )


def make(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([3, 5, 6, 8, 11, 15, 16, 17, 40])))) for i in range(25)]
    docs = []
    for i in range(120):
        words = draw.choices(vocabulary, k=draw.choice([0, 4, 30, 120]))
        if i % 2:
            planted = draw.choice(items)[1].split()
            for _ in range(draw.choice([0, 0, 1, 2, 3, 5])):
                planted[draw.randrange(len(planted))] = draw.choice(vocabulary)
            if draw.random() < 0.3:
                planted = planted[draw.randrange(len(planted)) :]
            at = draw.randrange(len(words) + 1)
            words[at:at] = planted
        docs.append((i, ", ".join(words).title()))
    return docs, items


def test_pairs_equal_brute_force(spark, documents):
    docs, items = make(5)
    extra = [(None, items[-1][1]), (900, None), (901, ""), (7, docs[7][1]), (902, "x " * 50_000 + items[-1][1])]
    bench = spark.createDataFrame([*items, (99, None), (None, ""), (1000, items[0][1].upper())], "item_id long, text string")
    bench = bench.withColumnRenamed("item_id", "item_id").selectExpr("*", "1 as item", "2 as words")
    got = {(r.doc_id, r.item_id) for r in D.overlaps(documents(docs + extra), bench).collect()}
    want = {(d, i) for d, t in docs + extra[:1] for i, x in items if brute(t, x)}
    if len(D.words(items[-1][1])) >= D.LEAST:
        want.add((902, items[-1][0]))
    assert got == want
    assert len(want) > 20


def test_clean_keeps_the_rest(spark, documents):
    docs, items = make(6)
    frame = documents([*docs, (None, None), (3, docs[3][1])])
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = D.clean(frame, bench)
    assert kept.columns == frame.columns
    want = sorted([d for d, t in [*docs, docs[3]] if not any(brute(t, x) for _, x in items)])
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want
    assert kept.where("doc_id is null").count() == 1


def test_empty_tables(spark, documents):
    docs, items = make(7)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert D.overlaps(documents(docs).limit(0), bench).count() == 0
    assert D.overlaps(documents(docs), bench.limit(0)).count() == 0


def test_filter_lets_every_key_through(spark):
    from newsmart.llm.common import bloom_of

    frame = spark.range(20_000).selectExpr("xxhash64(id) as h")
    bloom = bloom_of(frame, "h")
    keys = np.array([r.h for r in frame.collect()])
    assert bloom.holds(keys).all()
    assert bloom.holds(keys + 1).mean() < 0.02


def test_short_and_unspaced_items(spark, documents):
    items = [(1, "What is 2+2?"), (2, "中国的首都是哪个城市?请选择正确答案。"), (3, "日本で一番高い山は何ですか"), (4, "ประเทศไทยมีกี่จังหวัด"), (5, "a b c d e")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(i, f"Before it, {text} and after") for i, text in items]
    docs += [(10, "前言" + items[1][1] + "后记"), (11, "What is 3+2 or 2+3"), (12, "日本で一番長い川"), (13, "b c d e f")]
    got = {(r.doc_id, r.item_id) for r in D.overlaps(documents(docs), bench).collect()}
    assert got == {(i, i) for i, _ in items} | {(10, 2)}
