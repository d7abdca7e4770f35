from __future__ import annotations

import random

import pytest

from newsmart.llm import quality


def corpus(seed=1, n=600):
    draw = random.Random(seed)
    syllables = ["ta", "ri", "mo", "len", "su", "ka", "dor", "vi"]
    insults = ["grubbo", "snarkel", "vilepot", "dungwit"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(draw.randint(20, 120))]
        bad, toxic = draw.random() < 0.25, draw.random() < 0.2
        if bad:
            words = [w for w in words for _ in range(4)] if i % 2 else [w + "%%%" for w in words]
        elif toxic:
            for _ in range(4):
                words.insert(draw.randrange(len(words)), draw.choice(insults))
        rows.append((i, " ".join(words), f"site{i % 5}"))
        labels.append((i, 0 if bad else 1, 1 if toxic and not bad else 0))
    return rows, labels


def test_held_out_accuracy(spark, documents):
    rows, labels = corpus()
    known = spark.createDataFrame(labels[:400], "doc_id long, quality int, toxic int")
    extra = [(None, rows[1][1], None), (9000, None, "x"), (9001, "", "x"), (3, rows[3][1], "site3"), (9002, "ta ri mo " * 40_000, "x")]
    got = quality.judge(documents(rows + extra), known).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r.doc_id: r for r in got}
    wrong = [i for i, q, t in labels[400:] if by[i].kept != (q == 1 and t == 0)]
    assert len(wrong) <= 4
    assert not by[9000].kept and not by[9001].kept


def test_keep_leaves_columns(spark, documents):
    rows, labels = corpus(2, 300)
    frame = documents(rows)
    known = spark.createDataFrame([*labels, *labels, (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    kept = quality.keep(frame, known)
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in kept.collect()}
    good = {i for i, q, t in labels if q == 1 and t == 0}
    assert len(ids ^ good) <= 4


def test_sparse_sites_shrink_to_the_prior(spark, documents):
    """A bad site of many documents shifts its documents more than one of three."""
    rows, labels = corpus(3, 600)
    verdict = {i: q == 1 and t == 0 for i, q, t in labels}
    moved = [(i, t, ("bad/a" if i % 2 else "bad/b") if not verdict[i] else "good/a") for i, t, _ in rows]
    few = [i for i, _, s in moved if s.startswith("bad")][:3]
    moved = [(i, t, "rare/a") if i in few else (i, t, s) for i, t, s in moved]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judge(documents(moved), known).collect()}
    large = [got[i].site_shift for i, _, s in moved if s == "bad/a"]
    good = [got[i].site_shift for i, _, s in moved if s == "good/a"]
    assert max(large) < min(got[i].site_shift for i in few) < 0 < min(good)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 0, 1)], [(1, 1, 0), (2, 1, 0)]])
def test_too_few_labels(spark, documents, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert quality.judge(documents([(1, "a b"), (2, "c d")]), known).count() == 2
    assert quality.judge(documents([(1, "a b")]).limit(0), known).count() == 0


def logit(p):
    import math

    return math.log(p / (1 - p))


def strength(groups):
    """Moment estimate of what a prior is worth, from (n, sum, prior) of each group."""
    used = [g for g in groups if g[0] > 1]
    if len(used) < 2:
        return quality.MAX_STRENGTH
    n = sum(g[0] for g in used)
    between = sum(k * (s / k - mu) ** 2 for k, s, mu in used)
    chance = sum(mu * (1 - mu) for _, _, mu in used)
    tau = max(between - chance, 0) / n
    variance = sum(k * mu * (1 - mu) for k, _, mu in used) / n
    return min(max(variance / tau - 1, 1.0), quality.MAX_STRENGTH) if tau > 0 else quality.MAX_STRENGTH


def test_posteriors_equal_a_direct_computation(spark, documents):
    """Host and path posteriors, the document left out, from the same chances."""
    from collections import defaultdict

    documents([(1, "a")])
    draw = random.Random(9)
    rows = []
    for i in range(400):
        host = f"h{draw.randrange(6)}"
        rate = 0.2 + 0.12 * int(host[1])
        rows.append((i % 350 if i % 50 else None, host, f"{host}/{draw.randrange(4)}", int(1e6 * min(max(draw.gauss(rate, 0.2), 0.001), 0.999)), draw.choice([999_000, 400_000])))
    scores = spark.createDataFrame(rows, "doc_id long, host string, path string, good long, clean long")
    ps = [round(g / 1e6 * (c / 1e6) * 1e6) for *_, g, c in rows]
    hosts, paths = defaultdict(list), defaultdict(list)
    for (_, host, path, *_), p in zip(rows, ps):
        hosts[host].append(p / 1e6)
        paths[host, path].append(p / 1e6)
    mu = min(max(sum(ps) / 1e6 / len(ps), 1e-3), 1 - 1e-3)
    weight = strength([(len(x), sum(x), mu) for x in hosts.values()])
    prior = {h: (weight * mu + sum(x)) / (weight + len(x)) for h, x in hosts.items()}
    deep = strength([(len(x), sum(x), prior[h]) for (h, _), x in paths.items()])
    wanted = []
    for (doc_id, host, path, good, clean), p in zip(rows, ps):
        one, h, x = p / 1e6, hosts[host], paths[host, path]
        host_post = (weight * mu + sum(h) - one) / (weight + len(h) - 1)
        post = min(max((deep * host_post + sum(x) - one) / (deep + len(x) - 1), 1e-3), 1 - 1e-3)
        shift = logit(post) - logit(mu)
        wanted.append((str(doc_id), host, path, round(shift, 6), logit(min(max(one, 1e-6), 1 - 1e-6)) + shift >= 0 and clean >= 500_000))
    got = [(str(r.doc_id), r.host, r.path, round(r.site_shift, 6), r.kept) for r in quality._judged(scores).collect()]
    assert sorted(got) == sorted(wanted)
    assert max(abs(w[3]) for w in wanted) > 0.3


def test_repeated_rows_of_a_labelled_id_are_one_example(spark, documents, monkeypatch):
    seen = {}

    def counted(frame, name, stored=quality.stored):
        seen[name] = stored(frame, name)
        return seen[name]

    monkeypatch.setattr(quality, "stored", counted)
    rows, labels = corpus(4, 200)
    frame = documents(rows + [rows[0]] * 500 + [(0, f"other text {i}", "x") for i in range(100)])
    known = spark.createDataFrame(labels * 3, "doc_id long, quality int, toxic int")
    quality.train(frame, known)
    assert seen["quality-examples"].count() == 200


def test_columns_that_clash_with_those_of_the_operator(spark, documents):
    rows, labels = corpus(5, 200)
    frame = documents(rows)
    for name in ("host", "path", "good", "clean", "p", "nth", "_bad", "bad", "toxic", "kept"):
        frame = frame.withColumn(name, frame["doc_id"] + 1)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "doc_id as text", "1 as host")
    kept = quality.keep(frame, known)
    assert kept.columns == frame.columns and kept.where("host != doc_id + 1 or _bad != doc_id + 1").count() == 0
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.keep(documents(rows), known).collect()}
