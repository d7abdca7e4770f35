"""De-duplication, insert-ignore, foreign keys, and their behaviour on hot keys."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings, strategies as st

from newsmart import schemas as S
from newsmart.operators.dedup import dedup_content, first_per_key
from newsmart.operators.references import insert_ignore, orphan_analyses, valid_analyses

START = datetime(2024, 1, 1)
NEWS = "event_id string, timestamp timestamp, content_hash string, title string"


def rows(*specs):
    return [(e, START + timedelta(minutes=m), h, f"{e}/{h}") for e, m, h in specs]


def test_first_wins_and_ties_go_by_id(spark):
    news = spark.createDataFrame(
        rows(("b", 1, "x"), ("a", 1, "x"), ("c", 0, "y"), ("d", 5, "y"), ("e", 2, "")), NEWS
    )
    assert sorted(r.event_id for r in dedup_content(news).collect()) == ["a", "c", "e"]


def test_rows_are_dropped_before_the_shuffle(spark):
    # A third of all rows share one hash.
    news = spark.range(30_000).selectExpr(
        "lpad(string(id), 8, '0') as event_id",
        "timestamp_seconds(id) as timestamp",
        "if(id % 3 = 0, 'hot', sha2(string(id), 256)) as content_hash",
        "'t' as title",
    )
    kept = dedup_content(news)
    plan = plan_of(kept)
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    assert kept.count() == 20_001
    assert kept.where("content_hash = 'hot'").first().event_id == "00000000"


def test_top_k_keeps_order(spark):
    news = spark.createDataFrame(rows(*[(f"e{i}", i, "x") for i in range(9)]), NEWS)
    kept = first_per_key(news, ["content_hash"], ["timestamp"], 3)
    assert sorted(r.event_id for r in kept.collect()) == ["e0", "e1", "e2"]


def sequential(batch, stored):
    """What storing the rows one after another does."""
    hashes, ids = {h for _, h in stored}, {e for e, _ in stored}
    inserted, clashed = set(), set()
    for event, minute, digest in sorted(batch, key=lambda r: (r[1], r[0], r[2])):
        if digest in hashes:
            continue
        if event in ids:
            clashed.add((event, digest))
            continue
        hashes.add(digest)
        ids.add(event)
        inserted.add((event, digest))
    return inserted, clashed


def check(spark, batch, stored):
    frame = spark.createDataFrame(rows(*batch), NEWS)
    table = spark.createDataFrame(list(stored), "event_id string, content_hash string")
    inserts, clashes = insert_ignore(frame, table)
    got = [[(r.event_id, r.content_hash) for r in f.collect()] for f in (inserts, clashes)]
    expected = sequential(batch, stored)
    assert sorted(got[0]) == sorted(expected[0])
    assert sorted(got[1]) == sorted(expected[1])


@pytest.mark.parametrize(
    ("batch", "stored"),
    [
        ([("a", 0, "x"), ("b", 1, "x"), ("c", 2, "y")], []),
        ([("a", 0, "x"), ("a", 0, "x")], []),  # a repeat is not a clash
        ([("a", 0, "x")], [("a", "x")]),  # nor is a replay
        ([("a", 0, "new")], [("a", "x")]),
        ([("a", 0, "x"), ("a", 1, "y")], []),
        # b is a copy and never stored, so its correction is not a clash.
        ([("a", 0, "x"), ("b", 1, "x"), ("b", 2, "y")], []),
        # the refused row's content comes again under a free id.
        ([("a", 0, "x"), ("a", 1, "y"), ("b", 2, "y")], []),
        ([("a", 0, "y"), ("b", 1, "y")], [("a", "x")]),
        ([("a", 0, "x"), ("a", 1, "y"), ("b", 2, "y"), ("b", 3, "z"), ("c", 4, "z")], []),
    ],
)
def test_insert_ignore_cases(spark, batch, stored):
    check(spark, batch, stored)


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    batch=st.lists(
        st.tuples(st.sampled_from("abcde"), st.integers(0, 30), st.sampled_from("uvwxyz")),
        min_size=1,
        max_size=14,
        unique_by=lambda r: (r[0], r[2]),
    ),
    stored=st.sets(st.sampled_from([("a", "u"), ("b", "v"), ("f", "w")]), max_size=2),
)
def test_insert_ignore_is_the_sequential_result(spark, batch, stored):
    check(spark, batch, stored)


def references(spark, n=4000):
    """Analyses of which a third belong to one article; half the ids exist."""
    analyses = spark.range(n).selectExpr(
        "if(id % 3 = 0, 'e0', concat('e', id)) as article_event_id",
        "string(id) as summary",
        "'bullish' as sentiment",
        "0.5D as sentiment_confidence",
        "cast(array() as array<struct<name:string,entity_type:string,relevance_score:double>>)"
        " as entities",
        "cast(array() as array<string>) as key_topics",
        "timestamp_seconds(id) as analyzed_at",
        "'m' as model_id",
        "'1.0' as analysis_version",
    )
    return analyses, spark.range(0, n, 2).selectExpr("concat('e', id) as event_id")


@pytest.mark.parametrize("salts", [1, 7])
def test_foreign_key_halves(spark, salts):
    analyses, articles = references(spark)
    valid = valid_analyses(analyses, articles, salts)
    orphans = orphan_analyses(analyses, articles, salts)
    assert valid.columns == orphans.columns == S.ANALYSIS.fieldNames()
    ids = {r.summary for r in valid.collect()}
    expected = {str(i) for i in range(4000) if i % 3 == 0 or i % 2 == 0}
    assert ids == expected
    assert valid.count() + orphans.count() == 4000
    assert ids.isdisjoint({r.summary for r in orphans.collect()})


def test_salts_repeat_an_article_no_more_often_than_its_analyses(spark):
    from newsmart.operators.references import _salted

    analyses, articles = references(spark)
    _, ids = _salted(analyses, articles, 16)
    assert ids.count() <= analyses.count()


def test_hot_article_is_split(spark):
    """Sort-merge form, with thresholds low enough for the test's size."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        analyses, articles = references(spark, 60_000)
        valid = valid_analyses(analyses.repartition(16), articles)
        assert len(valid.collect()) == 40_000
        assert "skew=true" in plan_of(valid)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_first_in_place_equals_the_first_of_each_key(spark):
    from newsmart.operators.dedup import first_in_place, first_per_key

    rows = [(f"k{i}", i, "x" * 50) for i in range(3000)] + [(f"k{i % 7}", i, "y") for i in range(3000, 3100)]
    rows += [(None, 5, "n"), (None, 4, "m"), ("tie", 1, "a"), ("tie", 1, "b"), ("", 1, ""), ("same", 2, "s"), ("same", 2, "s")]
    frame = spark.createDataFrame(rows, "key string, at int, text string")
    order = ["at", "text"]
    assert sorted(first_in_place(frame, "key", order).collect(), key=str) == sorted(first_per_key(frame, ["key"], order).collect(), key=str)
    assert first_in_place(frame.limit(0), "key", order).count() == 0


def test_rows_whose_key_stands_once_are_not_shuffled(spark):
    from pyspark.sql import functions as F

    from newsmart.operators.dedup import by_repetition

    rows = [(f"k{i}", "x" * 50) for i in range(3000)] + [(f"k{i}", "y") for i in range(40)]
    single, several = by_repetition(spark.createDataFrame(rows, "key string, text string"), F.col("key"))
    assert 80 <= several.count() < 80 + 300 and single.count() + several.count() == len(rows)
    plan = single._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line and "text" in line]
    assert not moved and "BroadcastHashJoin" in plan


def test_only_clashes_are_shuffled_to_find_them(spark):
    from conftest import plan_of

    news = spark.createDataFrame(rows(*[(f"e{i}", i, f"h{i}") for i in range(50)], ("e7", 60, "new")), NEWS)
    _, clashes = insert_ignore(news, news.limit(0).select("content_hash", "event_id"))
    assert [(r.event_id, r.content_hash) for r in clashes.collect()] == [("e7", "new")]
    plan = plan_of(clashes)
    assert plan.index("Window") < plan.index("LeftSemi")


def rows_shuffled(frame, column):
    """Most rows that an exchange with the column has moved, in a frame that has been run."""
    found = [0]

    def walk(plan) -> None:
        if plan.nodeName() == "Exchange" and column in plan.schema().fieldNames():
            found.append(plan.metrics().apply("shuffleRecordsWritten").value())
        if plan.nodeName() == "AdaptiveSparkPlan":
            walk(plan.executedPlan())
        elif "QueryStage" in plan.nodeName():
            walk(plan.plan())
        children = plan.children().iterator()
        while children.hasNext():
            walk(children.next())

    walk(frame._jdf.queryExecution().executedPlan())
    return max(found)


@pytest.mark.parametrize(("known", "most"), [(3000, 0), (2990, 100), (1000, 3000), (0, 3000)])
def test_what_is_known_is_not_shuffled(spark, known, most):
    batch = [(f"e{i}", i, f"h{i}") for i in range(3000)]
    news = spark.createDataFrame(rows(*batch), NEWS)
    table = spark.createDataFrame([(f"e{i}", f"h{i}") for i in range(known)], "event_id string, content_hash string")
    inserts, _ = insert_ignore(news, table)
    assert sorted(r.event_id for r in inserts.collect()) == sorted(f"e{i}" for i in range(known, 3000))
    assert 3000 - known <= rows_shuffled(inserts, "title") <= most
