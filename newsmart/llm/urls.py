"""URL filters: rules indexed by their rarest literal token.

A rule names the literal tokens ``[a-z0-9]+`` that every URL it matches must
hold as whole tokens.  It is indexed under the one of them that the table's URLs
hold least often; the tokens of a URL then fetch its candidate rules by a join,
and only those run their regular expression.  A rule without a literal cannot be
indexed and is refused.

Host and path rules (``allow`` or ``block``, the longest wins) come before the
patterns, which block.  Null or unusual URLs have an empty host and path, match
nothing and are allowed.  Repeated rows are judged each on their own, null ids
are kept, further columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from newsmart.llm.common import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is matched against ``host + rest of the URL``, the host in lower case."""

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str = "block"
    rank: int = 0  # 0 for patterns, the rule's length for host and path rules


def _tokens(text: str) -> tuple[str, ...]:
    return tuple(re.findall("[a-z0-9]+", text.lower()))


def site_rule(verdict: str, rule: str) -> Rule:
    """A rule like ``allow example.com/en/``: the host with its subdomains, and a path to begin with."""
    host, slash, path = rule.partition("/")
    path = slash + path
    whole = path[: max(path.rfind(x) for x in "/.-_") + 1]  # the last token may go on in a URL
    pattern = rf"^([^/?#]*\.)?{re.escape(host)}{re.escape(path)}" if path else rf"^([^/?#]*\.)?{re.escape(host)}([/?#]|$)"
    return Rule(rule, pattern, _tokens(host) + _tokens(whole), verdict, len(rule))


#: The rules of the query.
SITE_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

#: Patterns for addresses that carry no text worth keeping.
PATTERNS = (
    Rule("adult", r"^[^/]*\b(xxx)\b", ("xxx",)),
    Rule("calendar", r"/calendar/\d{4}/\d{1,2}", ("calendar",)),
    Rule("cart", r"/cart(/|\?|$)", ("cart",)),
    Rule("casino", r"^[^/]*\bcasino\b", ("casino",)),
    Rule("feed", r"/feed/?$", ("feed",)),
    Rule("link farm", r"^([^/]*\.)?spam-farm\.", ("spam", "farm")),
    Rule("login", r"/login(/|\?|\.|$)", ("login",)),
    Rule("pills", r"^([^/]*\.)?[a-z-]*\bpills\.", ("pills",)),
    Rule("print view", r"[?&]print=(1|true|yes)\b", ("print",)),
    Rule("reply form", r"[?&]replytocom=\d+", ("replytocom",)),
    Rule("session", r"[?&;](phpsessid)=", ("phpsessid",)),
    Rule("torrent", r"/torrents?/|\btorrent\.", ("torrent",)),
    Rule("wp admin", r"/wp-admin/", ("wp", "admin")),
)


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host in lower case (A-Z only), path, and what the rules see; empty without ``://``."""
    found = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(found, "(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(found, "(?s)^.*?://[^/?#]*([^?#]*)", 1)
    rest = F.regexp_extract(found, "(?s)^.*?://[^/?#]*(.*)$", 1)
    return host, path, F.concat(host, rest)


def _token_array(subject: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(subject, _UPPER, _LOWER), F.lit("[a-z0-9]+"), F.lit(0)))


def index(urls: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """token, name, pattern, verdict, rank: each rule under its rarest token over all of ``urls``.

    Counts are of the rules' own tokens only and end in one row per token.
    """
    for rule in rules:
        if not rule.tokens:
            raise ValueError(f"rule {rule.name} has no literal token to be indexed by")
    spark = urls.sparkSession
    listed = stored(
        spark.createDataFrame(
            [(t, r.name, r.pattern, r.verdict, r.rank) for r in rules for t in dict.fromkeys(r.tokens)],
            "token string, name string, pattern string, verdict string, rank int",
        ).coalesce(1),
        "url-rules",
    )
    counts = (
        urls.select(F.explode(_token_array(parts(F.col("url"))[2])).alias("token"))
        .join(listed.select("token").distinct(), "token", "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    rarest = (
        listed.join(counts, "token", "left")
        .groupBy("name", "pattern", "verdict", "rank")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    )
    return stored(rarest.coalesce(1), "url-index")


def judge(pages: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, and the name of the pattern that blocked."""
    if rules is None:
        rules = tuple(site_rule(*r) for r in SITE_RULES) + PATTERNS
    urls = pages.select(pages["page_id"].alias("page_id"), pages["url"].alias("url"))
    host, path, subject = parts(F.col("url"))
    rows = urls.select(
        "page_id", host.alias("host"), path.alias("path"), subject.alias("subject")
    ).withColumn("row", F.monotonically_increasing_id())
    fetched = rows.withColumn("token", F.explode_outer(_token_array(F.col("subject")))).join(
        index(urls, rules), "token", "left"
    )
    hit = F.expr("pattern is not null and subject rlike pattern")
    site = F.struct("rank", "name", "verdict")
    # A row's tokens are in one task, so the partial step leaves one row of each.
    best = fetched.groupBy("row").agg(
        F.first("page_id").alias("page_id"),
        F.first("host").alias("host"),
        F.first("path").alias("path"),
        F.max(F.when(hit & (F.col("rank") > 0), site)).alias("site"),
        F.min(F.when(hit & (F.col("rank") == 0), F.col("name"))).alias("pattern"),
    )
    return best.select(
        "page_id",
        "host",
        "path",
        F.col("site.name").alias("rule"),
        F.coalesce(F.col("site.verdict"), F.when(F.col("pattern").isNotNull(), "block").otherwise("allow")).alias(
            "verdict"
        ),
        "pattern",
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql() -> str:
    ordered = sorted((site_rule(*r) for r in SITE_RULES), key=lambda r: -r.rank)

    def fits(name: str) -> str:
        host, slash, path = name.partition("/")
        path = slash + path
        return f"(host = {_quoted(host)} or ends_with(host, {_quoted('.' + host)})) and starts_with(path, {_quoted(path)})"

    names = " ".join(f"when {fits(r.name)} then {_quoted(r.name)}" for r in ordered)
    verdicts = " ".join(f"when {_quoted(r.name)} then {_quoted(r.verdict)}" for r in ordered)
    patterns = " ".join(
        f"when regexp_matches(subject, {_quoted(r.pattern)}) then {_quoted(r.name)}"
        for r in sorted(PATTERNS, key=lambda r: r.name)
    )
    return f"""
with cut as (
  select page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*(.*)$', 1) as rest
  from pages
), seen as (select *, host || rest as subject from cut),
ruled as (
  select page_id, host, path, case {names} end as rule, case {patterns} end as pattern from seen
)
select page_id, host, path, rule,
       coalesce(case rule {verdicts} end, case when pattern is not null then 'block' else 'allow' end) as verdict,
       pattern
from ruled"""


ORACLE_SQL = _sql()
