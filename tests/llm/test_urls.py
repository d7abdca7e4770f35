from __future__ import annotations

import pytest
from parity import connect, oracle_rows, spark_rows

from newsmart.llm import queries, urls

SF_DIR = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    sql = queries.ORACLES["op6_url_filters"]
    assert spark_rows(queries.QUERIES["op6_url_filters"](spark, SF_DIR)) == oracle_rows(connect(SF_DIR), sql)


CASES = [
    ("http://EXAMPLE.com/en/1", "example.com", "/en/1", "example.com/en/", "block"),
    ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://a.www.example.com/en/x?y", "a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("https://com", "com", "", None, "allow"),
    ("https://x.net/es/1#t", "x.net", "/es/1", "net/es/", "block"),
    ("https://x.net/ES/1", "x.net", "/ES/1", None, "allow"),
    ("https://spam-farm.example.org/en/7", "spam-farm.example.org", "/en/7", None, "block"),
    ("https://x.org/wp-admin/a", "x.org", "/wp-admin/a", None, "block"),
    ("https://x.org/a?PHPSESSID=1", "x.org", "/a", None, "allow"),
    ("https://x.org/a?phpsessid=1", "x.org", "/a", None, "block"),
    ("a.com/path", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("x://a?b://c/d", "a", "", None, "allow"),
    ("://", "", "", None, "allow"),
    ("http://É.com/\n/z", "É.com", "/\n/z", "com/", "allow"),
]


def test_cases(spark):
    frame = spark.createDataFrame(
        [(i, c[0], "h", 1, "p") for i, c in enumerate(CASES)] + [(None, None, None, None, None)],
        "page_id long, url string, host string, row int, pattern string",
    )
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(frame).collect()}
    assert got == {i: c[1:] for i, c in enumerate(CASES)} | {None: ("", "", None, "allow")}
    assert urls.judge(frame.limit(0)).count() == 0
    assert urls.judge(frame.union(frame)).count() == 2 * len(CASES) + 2


def test_a_rule_is_indexed_by_its_rarest_token(spark):
    frame = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://b.com/x"), (3, "http://a.com/y")], "page_id long, url string")
    made = urls.index(frame, (urls.site_rule("block", "a.com/x/"),)).collect()
    assert [r.token for r in made] in (["a"], ["x"])
    with pytest.raises(ValueError, match="no literal token"):
        urls.index(frame, (urls.Rule("any", ".*", ()),))


def test_every_pattern_needs_its_tokens():
    import re

    seen = {"adult": "xxx.org/", "calendar": "a.org/calendar/2020/1", "cart": "a/cart", "casino": "casino.org/",
            "feed": "a/feed", "link farm": "spam-farm.org/", "login": "a/login?", "pills": "cheap-pills.org/",
            "print view": "a/?print=1", "reply form": "a?replytocom=3", "session": "a?phpsessid=1",
            "torrent": "a/torrent/", "wp admin": "a/wp-admin/"}
    for rule in urls.PATTERNS:
        url = seen[rule.name]
        assert re.search(rule.pattern, url)
        if rule.name != "torrent":
            assert set(rule.tokens) <= set(re.findall("[a-z0-9]+", url))
