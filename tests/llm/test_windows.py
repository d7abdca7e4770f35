from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from newsmart.llm import queries, windows


def pad(n, capacity):
    return 0 if n & (n - 1) == 0 else capacity - n


def least(at, cost, capacity):
    """Least cost by trying every window."""
    best = {0: 0}
    for p, c in zip(at, cost):
        best[p] = c + min(best[q] + pad(p - q, capacity) for q in best if p - q <= capacity)
    return best[at[-1]]


def total(cuts, at, cost, capacity):
    by = dict(zip(at, cost))
    return sum(by[b] + pad(b - a, capacity) for a, b in zip(cuts, cuts[1:]))


documents_of = st.lists(
    st.integers(1, 150).flatmap(lambda n: st.tuples(st.just(n), st.sets(st.integers(1, max(n - 1, 1)), max_size=8))),
    min_size=1, max_size=12,
)


@settings(max_examples=200, deadline=None)
@given(documents_of, st.sampled_from([32, 64]), st.integers(1, 5))
def test_cuts_cost_least_however_the_stream_arrives(docs, capacity, step):
    lengths = [n for n, _ in docs]
    inner = [np.array(sorted(x for x in s if x < n), int) for n, s in docs]
    whole = windows.places(lengths, inner, capacity)
    cuts, found, at, cost = windows.Cuts(capacity), [0], [], []
    for i in range(0, len(docs), step):
        more = windows.places(lengths[i : i + step], inner[i : i + step], capacity, sum(lengths[:i]))
        at += more[0].tolist()
        cost += more[1].tolist()
        cuts.add(*more)
        part = cuts.decided()
        assert part[0] == found[-1]
        found += part[1:]
    part = cuts.decided(end=True)
    assert part[0] == found[-1]
    found += part[1:]
    assert (at, cost) == tuple(x.tolist() for x in whole)
    assert found[-1] == sum(lengths) and all(b - a <= capacity for a, b in zip(found, found[1:]))
    assert total(found, at, cost, capacity) == least(at, cost, capacity)


def check(docs, rows, capacity=1024):
    """Round trip: rows hold every id of each document once, in order, and sequences are gapless."""
    tokenizer = Tokenizer.from_file(windows.default_tokenizer())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    wanted = defaultdict(list)
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        wanted[doc_id].append(np.array(ids, "<u4").tobytes())
    assert by_doc.keys() == wanted.keys()
    for doc_id, texts in wanted.items():
        own = sorted(by_doc[doc_id], key=lambda r: r["start"])
        if len(texts) == 1:
            at = 0
            for r in own:
                assert r["start"] == at and r["doc_tokens"] == len(texts[0]) // 4
                assert r["ids_crc32"] == zlib.crc32(texts[0][4 * at : 4 * (at + r["length"])])
                at += r["length"]
            assert 4 * at == len(texts[0])
        assert 4 * sum(r["length"] for r in own) == sum(map(len, texts))
    padding = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity and {r["sequence_tokens"] for r in own} == {at}
        padding += pad(at, capacity)
    return padding


def test_null_empty_repeated_special_and_long_texts(documents):
    docs = [
        (1, "One sentence. Another one!\nA line"), (2, None), (3, ""), (4, "same text."), (4, "same text."), (None, "no id"),
        (5, "word " * 9000), (6, "x" * 30_000), (7, "a <|endoftext|> b"), (8, "  spaced \n\n out\t"),
        (9, "漢字仮名交じり文。" * 400), (10, "𝔘𝔫𝔦𝔠𝔬𝔡𝔢 ࿅ꙮ🙂 é"), (11, "Short. " * 3000),
    ]
    rows = windows.packed(documents(docs).coalesce(1)).collect()
    padding = check(docs, rows)
    assert padding <= sum(r["length"] for r in rows) * 0.02 + 512


def test_sequences_hold_the_ids(documents):
    docs = documents([(i, f"Sentence {i}. " * (i * 7 % 90)) for i in range(120)]).coalesce(2)
    parts = {r["sequence_id"]: 0 for r in windows.packed(docs).collect()}
    made = windows.sequences(docs).collect()
    assert {r["sequence_id"] for r in made} == parts.keys() and len(made) == len(parts)
    ids = [i for r in sorted(made, key=lambda r: r["sequence_id"]) for i in r["ids"]]
    assert ids.count(0) == 120
    assert all(r["padding"] == pad(len(r["ids"]), 1024) for r in made)


def test_empty_table(documents):
    empty = documents([(1, "a")]).where("doc_id < 0")
    assert windows.packed(empty).count() == windows.sequences(empty).count() == 0


def test_other_tokenizers_are_taken(documents):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = windows.packed(documents([(1, "One. Two. " * 700)]), 256, path).collect()
    assert sum(r["length"] for r in rows) == rows[0]["doc_tokens"] and max(r["sequence_tokens"] for r in rows) <= 256


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_over_a_whole_table(spark, sf):
    path = f"/root/testdata/{sf}"
    docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op12_monotone_queue_windows(spark, path).collect()
    padding = check(docs, rows)
    assert padding < 0.004 * sum(r["length"] for r in rows)


def test_libraries_agree_on_common_letters():
    """tiktoken and tokenizers give the same ids around every letter that takes the fast path."""
    words = windows.Vocabulary(windows.default_tokenizer())
    texts = [f"a{chr(c)}b {chr(c)} 1{chr(c)}\n{chr(c)}{chr(c)} 's" for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    texts = [t for t in texts if not windows._COMMON.search(t)]
    slow = words.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert len(texts) > 20_000
    assert [t for t, s in zip(texts, slow) if s.ids != words.fast.encode_ordinary(t)] == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab é.'s1\n\t \u00a0", max_size=30), max_size=4))
def test_libraries_agree_on_any_spacing(texts):
    path = windows.default_tokenizer()
    words = windows._LOADED.get(path) or windows._LOADED.setdefault(path, windows.Vocabulary(path))
    made = [words.ids(t) for t in texts]
    assert [x.tolist() for x in made] == [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
