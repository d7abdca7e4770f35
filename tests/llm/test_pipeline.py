from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsmart.llm import lines, quality, queries
from newsmart.llm.common import stored, table

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    from llm.test_jaccard import brute as components_of
    from llm.test_lines import brute as lines_of

    docs = table(spark, SF_DIR, "documents")
    labels = {r.doc_id: r for r in table(spark, SF_DIR, "labels").collect()}
    items = [r.text for r in table(spark, SF_DIR, "benchmark").collect()]
    columns = docs.columns
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(stored(stage(spark, steps[-1], SF_DIR), "test-stage"))
        if name != "best-fit packing":
            assert steps[-1].columns == columns
    rows = [[(r.doc_id, r.text, r.source) for r in s.collect()] for s in steps[:-1]]
    kept = {r[0] for r in rows[1]}
    verdict = quality.judge(docs, table(spark, SF_DIR, "labels")).where("kept").collect()
    assert kept == {r.doc_id for r in verdict}
    wrong = [i for i, x in labels.items() if (i in kept) != (x.quality == 1 and x.toxic == 0)]
    assert len(wrong) <= 0.15 * len(labels)  # 87 labels teach little
    assert sorted(((d, t) for d, t, _ in rows[2]), key=repr) == lines_of(rows[1], lines.MIN_SITES)
    least = {c for _, _, c in components_of([r[:2] for r in rows[2]])}
    assert {r[0] for r in rows[3]} == least
    from llm.test_decontaminate import brute as holds

    assert {r[0] for r in rows[4]} == {d for d, t, _ in rows[3] if not any(holds(t or "", x) for x in items)}
    packed = steps[-1].collect()
    assert {r.doc_id for r in packed} == {r[0] for r in rows[4]}


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_runs(spark, name):
    assert queries.QUERIES[name](spark, SF_DIR).count() > 0


def test_stages_decide_on_rows(spark, documents):
    """Null and repeated ids, clean and bad rows mixed: each row meets its own fate."""
    from newsmart.llm import decontaminate, jaccard

    def texts(frame):
        return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)

    one, two, three = ("".join(f"{w}{i} " for i in range(30)) for w in "abc")
    bench = spark.createDataFrame([(1, one)], "item_id long, text string")
    mixed = [(None, one), (None, two), (None, None), (7, one), (7, three)]
    assert texts(decontaminate.clean(documents(mixed), bench)) == sorted([mixed[1], mixed[2], mixed[4]], key=repr)

    copies = [(None, one), (None, one), (None, two), (5, two), (6, three), (6, three), (8, three), (8, one), (None, None), (None, "")]
    want = [(8, one), (5, two), (6, three), (None, None), (None, "")]
    assert texts(jaccard.keep_first(documents(copies))) == sorted(want, key=repr)
    nulls = [(None, one), (None, one), (None, one + "z"), (None, two)]
    got = texts(jaccard.keep_first(documents(nulls)))
    assert len(got) == 2 and got[1] == (None, two) and got[0] in nulls

    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    verdicts = quality.judge(docs, labels).where("kept").collect()
    good = docs.where(docs["doc_id"] == verdicts[0].doc_id)
    unnamed = good.withColumn("doc_id", F.lit(None).cast("long"))
    blank = unnamed.withColumn("text", F.lit(""))
    repeated = good.withColumn("text", F.lit(""))
    kept = quality.keep(docs.unionByName(unnamed).unionByName(blank).unionByName(repeated), labels)
    assert kept.where("doc_id is null").count() == 1 and kept.where("text = ''").count() == 0
    assert kept.where(kept["doc_id"] == verdicts[0].doc_id).count() == 1
