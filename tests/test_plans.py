"""What the plans of the batch queries must and must not contain."""

from __future__ import annotations

import pytest
from conftest import plan_of

from newsmart.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"

# Queries that run jobs of their own are checked where their operators are.
_EAGER = {
    "topic_dispatch",
    "insert_ignore",
    "insert_conflicts",
    "lake_roundtrip",
    "fan_out",
    "insert_history",
    "analyses_history",
    "insert_chain",
    "process_news_in_place",
    "dedup_source_key_in_place",
}
LAZY = sorted(n for n in QUERIES if n not in _EAGER and not n.startswith("stream_"))


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan_of(QUERIES[n](spark, SF_DIR)) for n in LAZY}


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_row_at_a_time_python(plans, name):
    for operator in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "FlatMapGroups"):
        assert operator not in plans[name]


@pytest.mark.parametrize("name", [n for n in LAZY if "first" not in n])
def test_ranks_are_limited_in_the_map_tasks(plans, name):
    plan = plans[name]
    windows = plan.count("Window [")
    assert plan.count("WindowGroupLimit") == 2 * windows
    assert plan.count("Partial") == windows


@pytest.mark.parametrize(
    "name",
    [
        "content_hash",
        "enrich_companies",
        "routing_key",
        "json_roundtrip",
        "render_prompt",
        "extract_tickers",
        "validate_records",
        "normalize_market",
        "normalize_filing",
        "union_sources",
        "entity_rows",
        "parse_analysis",
    ],
)
def test_row_work_needs_no_shuffle(plans, name):
    assert "Exchange" not in plans[name]


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("enrich_companies", "doc_id:bigint"),
        ("ticker_hourly", "doc_id:bigint"),
        ("event_hourly", "ts:timestamp_ntz,event_type:string,value:double"),
        ("articles_by_ticker", "doc_id:bigint,text:string,lang:string,n_chars:bigint"),
        ("ticker_counts", "doc_id:bigint,text:string"),
    ],
)
def test_scans_read_what_is_used(plans, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plans[name]


def test_lake_scan_prunes_folders(plans):
    assert "PartitionFilters: [isnotnull(ticker" in plans["lake_scan_ticker"]


def test_pages_push_their_last_time_to_the_scan(plans):
    assert "TakeOrderedAndProject" in plans["articles_page"]
    assert "Subquery" in plans["articles_page"]
