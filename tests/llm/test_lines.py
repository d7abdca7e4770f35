from __future__ import annotations

from collections import defaultdict

import pytest
from parity import connect, oracle_rows, spark_rows

from newsmart.llm import lines, queries

SF_DIR = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    sql = queries.ORACLES["op2_site_spread_line_dedup"]
    assert spark_rows(queries.QUERIES["op2_site_spread_line_dedup"](spark, SF_DIR)) == oracle_rows(connect(SF_DIR), sql)


def brute(rows, min_sites):
    """By rows: the row of the least id keeps a line, at its first place; rows must differ in id, or in nothing."""
    sites, first = defaultdict(set), {}
    for n, (doc_id, text, site) in enumerate(rows):
        for place, line in enumerate((text or "").split("\n")):
            if key := line.strip(" \t\n\x0b\f\r"):
                sites[key].add(site or "")
                at = (doc_id is None, doc_id or 0, n, place)
                if key in first and len(sites[key]) >= min_sites:
                    assert at[:2] != first[key][:2] or rows[n] == rows[first[key][2]]
                first[key] = min(first.get(key, at), at)
    out = []
    for n, (doc_id, text, site) in enumerate(rows):
        kept = []
        for place, line in enumerate((text or "").split("\n")):
            key = line.strip(" \t\n\x0b\f\r")
            if not key or len(sites[key]) < min_sites or first[key][2:] == (n, place):
                kept.append(line)
        out.append((doc_id, None if text is None else "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_sites", [3, 40])
def test_equals_brute_force(spark, documents, min_sites):
    rows = [(i, f"own {i}\nshared {i % 7}\n  shared {i % 3} \n\nall\nall", f"site{i % 50}") for i in range(300)]
    rows += [(None, "all\nx", "n"), (None, None, "n"), (5, "all", None), (6, "", "b"), (7, "\n\n", "c"), (8, "all " * 30_000, "d")]
    got = lines.dedup(documents(rows), min_sites)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == brute(rows, min_sites)
    assert got.columns == documents(rows).columns
    assert got.where("text is not null and n_chars != length(text)").count() == 0


def test_wrong_estimates_are_counted_exactly(spark, documents, monkeypatch):
    """With rough sketches the lines near the threshold still come out right."""
    monkeypatch.setattr(lines, "LOG2_REGISTERS", 4)
    monkeypatch.setattr(lines, "ERROR", 1.04 / 4)
    rows = [(k * 1000 + i, f"line {k}", f"s{i}") for k, n in enumerate((38, 39, 40, 41, 60, 100)) for i in range(n)]
    got = sorted(((r.doc_id, r.text) for r in lines.dedup(documents(rows), 40).collect()), key=repr)
    assert got == brute(rows, 40)


def test_empty_table(spark, documents):
    assert lines.dedup(documents([(1, "a")]).limit(0)).count() == 0


@pytest.mark.parametrize("ids", [range(8), [None] * 8, [7] * 8, [None, None, 3, 3, 3, None, 1, 1]])
@pytest.mark.parametrize("copies", [1, 2, 5])
def test_one_row_keeps_a_line_whatever_the_ids(spark, documents, ids, copies):
    """Eight rows on eight sites share a line; with copies, some rows come several times."""
    rows = [(i, f"own {n}\nshared\nshared", f"site{n}") for n, i in enumerate(ids)]
    rows += rows[:5] * (copies - 1)
    got = [(r.doc_id, r.text) for r in lines.dedup(documents(rows)).collect()]
    # Ids that repeat leave open which of their rows it is.
    assert [text.count("shared") for _, text in got if "shared" in text] == [1]
    kept = next(i for i, text in got if "shared" in text)
    assert kept == min((i for i in ids if i is not None), default=None)
    bare = sorted(((i, text.split("\n")[0]) for i, text in got), key=repr)
    assert bare == sorted(((i, text.split("\n")[0]) for i, text, _ in rows), key=repr)


def test_columns_that_clash_with_those_of_the_join(spark, documents):
    names = ("_gone", "_row", "_lost", "_firsts", "_twin", "_lead", "row", "doc", "first_row", "site", "line")
    rows = [(i // 2, "all\nx", f"s{i // 2}") for i in range(12)]
    docs = documents(rows)
    for n in names:
        docs = docs.withColumn(n, docs["doc_id"] * 2)
    got = lines.dedup(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == brute(rows, lines.MIN_SITES)
    assert all(r[n] == r.doc_id * 2 for r in got.collect() for n in names)
