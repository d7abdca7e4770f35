"""Main text of pages with a style tree per site.

Every page is parsed into its elements, each known by its path of tags and
classes.  The pages of a host are merged by path: a presentation node holds the
child layouts seen there, a content node the texts.  A node's importance is
high where layouts or texts differ from page to page and low where they repeat;
for a path seen on m pages, the layouts' importance is their entropy to base m, and
the texts' is one less the mean of log(pages of a text) to base m.  The larger of both
counts, drawn towards one as if ``PRIOR`` more pages differed, so that few pages are
little evidence.  Pages of a host that are alike count as one.

A branch is as important as the most important thing in it.  Block elements whose
branch is of low importance are removed from each page; text and inline elements go with
their block only, never alone.  Inside an article or main element only a container without
text of its own may go, and never a paragraph, heading, list or table by itself.  A page
that would lose all its text keeps it.  What HTML itself marks as no article (menus,
forms, scripts) has importance zero, whatever it holds.  Pages without an article fall
back to ``main``, then to elements named as content, then to the body.

The tree is one row per host and path after grouped counts, texts as hashes; a
host with a third of all pages is counted by partial sums, and only the paths of low
importance are joined back.  Null html or url is empty: such a page has no text, or no
host.  Repeated rows are extracted each on their own but count as one page,
further columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from newsmart.llm.common import stored, text_of
from newsmart.llm.urls import parts

#: Pages that a site is taken to have besides, on which everything differs.
PRIOR = 2
#: Importance up to which a branch is removed: outside an article, and a container in one.
LOW, LOW_INSIDE = 0.2, 0.02

# Fixed names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary"
    " table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - {"br", "body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "option", "legend"}
ENDS_LIKE = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
SCOPE = frozenset("article aside body div footer form header html li main nav section table td th ul ol dl".split())
#: Elements that hold no article text.
CHROME = frozenset(
    "aside audio button canvas datalist dialog embed footer form frame head iframe input label map menu nav noscript"
    " object script select style svg template textarea title video".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status tablist toolbar".split()
)
#: Words of a class or id that mark menus, headers, footers, sidebars, notices, adverts, forms and comments.
MARKS = frozenset(
    "ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs comment comments commentlist"
    " consent cookie cookies copyright disclaimer disqus donate footer form gdpr header hidden legal login masthead"
    " menu modal nav navbar navigation navi newsletter notice notification outbrain overlay pager pagination paywall"
    " popup promo promoted promotion recommended related replies reply respond rail search share sharing sidebar"
    " signup skip skiplink social sponsor sponsored sponsors subscribe subscription taboola tags teaser toolbar topbar"
    " widget widgets".split()
)
CONTENT = frozenset("article articlebody body content entry post story text".split())
KEEP = frozenset("article body html main".split())
PARAGRAPH = frozenset("blockquote dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 li ol p pre table tbody td th tr ul".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


class Node:
    __slots__ = ("tag", "path", "dropped", "kind", "parent", "children", "spoken")

    def __init__(self, tag: str, path: int, dropped: bool, kind: int, parent: Node | None = None):
        self.tag, self.path, self.dropped, self.kind, self.parent = tag, path, dropped, kind, parent
        self.children: list[int] = []
        self.spoken = False  # has text of its own


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _hash(text: str) -> int:
    return _signed(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")))


class Page(HTMLParser):
    """One page: its elements by path, and its text in order.

    ``low`` holds the paths of low importance, ``low_inside`` those so low that they may
    go inside an article.
    """

    def __init__(self, html: str, low: frozenset = frozenset(), low_inside: frozenset = frozenset()):
        super().__init__(convert_charrefs=True)
        self.low, self.low_inside = low, low_inside
        # kind: 0 plain, 1 named as content, 2 main, 3 article; children inherit it.
        self.stack = [Node("", 0, False, 0)]
        self.nodes: list[Node] = []
        self.chunks: list[tuple[Node | None, str]] = []  # where a text stands; None: a block ends here
        self.texts: list[tuple[int, str]] = []  # path, text of its own
        self.feed(_ended(html))
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ENDS_P:
            self._end(("p",))
        elif tag in ENDS_LIKE:
            self._end(ENDS_LIKE[tag])
        if tag in BLOCK:
            self.chunks.append((None, ""))
        if tag in VOID:
            return
        parent = self.stack[-1]
        node = self._node(tag, dict(attrs), parent)
        parent.children.append(node.path)
        self.nodes.append(node)
        self.stack.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the slash

    def _node(self, tag: str, attrs: dict, parent: Node) -> Node:
        names = " ".join(filter(None, (attrs.get("class"), attrs.get("id"))))
        layout = re.sub(r"\d+", "0", names) if names else ""
        path = _hash(f"{parent.path}/{tag}.{layout}")
        words = {w.lower() for w in _WORD.findall(names)} if names else set()
        role = (attrs.get("role") or "").lower()
        marked = words & MARKS and (tag not in KEEP or tag == "article" and words & {"comment", "reply", "teaser", "ad"})
        hidden = "hidden" in attrs or re.search(r"display\s*:\s*none", attrs.get("style") or "")
        kind = parent.kind
        if tag == "article":
            kind = 3
        elif tag == "main" or role == "main" or (attrs.get("itemprop") or "") == "articleBody":
            kind = max(kind, 2)
        elif words & CONTENT and tag in ("div", "section", "td"):
            kind = max(kind, 1)
        chrome = tag in CHROME or role in ROLES or marked or hidden or (tag == "header" and parent.kind < 2)
        return Node(tag, path, parent.dropped or bool(chrome), kind, parent)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.chunks.append((None, ""))
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def _end(self, tags: object) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                del self.stack[i:]
                return
            if self.stack[i].tag in SCOPE:
                return

    def handle_data(self, data: str) -> None:
        node = self.stack[-1]
        if data.strip() and node.tag not in ("script", "style"):
            self.texts.append((node.path, data))
            node.spoken = True
        if not node.dropped:
            self.chunks.append((node, data))

    def _unimportant(self) -> set[Node]:
        """Elements in a branch that the style tree removes."""
        whole = {id(n): [n.path in self.low, n.path in self.low_inside] for n in self.nodes}
        for n in reversed(self.nodes):  # children come after their parents
            own, above = whole[id(n)], whole.get(id(n.parent))
            if above:
                above[:] = above[0] and own[0], above[1] and own[1]
        gone: set[Node] = set()
        for n in self.nodes:
            low, inside = whole[id(n)]
            if n.kind < 2:
                goes = low and n.tag in BLOCK
            else:
                goes = inside and n.tag in BLOCK and n.tag not in PARAGRAPH and not n.spoken
            if n.parent in gone or goes and n.tag not in KEEP:
                gone.add(n)
        return gone

    def text(self) -> str:
        """The text of the article, blocks and words apart by one space."""
        gone = self._unimportant() if self.low else set()
        return self._joined(gone) or (self._joined(set()) if gone else "")

    def _joined(self, gone: set[Node]) -> str:
        left = [(n, data) for n, data in self.chunks if n not in gone]
        best = max((n.kind for n, data in left if n and data.strip()), default=0)
        pieces = [data if n else " " for n, data in left if n is None or n.kind == best]
        return " ".join("".join(pieces).split())

    def features(self) -> set[tuple[int, int, int]]:
        """(path, 0, layout) of each element's children and (path, 1, text) of each text."""
        out = {(n.path, 0, _hash(repr(n.children))) for n in self.nodes}
        out |= {(path, 1, _hash(" ".join(data.split()))) for path, data in self.texts}
        return out


def _ended(html: str) -> str:
    """Without a comment or tag that the end of the page cuts off."""
    if (at := html.rfind("<!--")) > html.rfind("-->"):
        html = html[:at]
    return html[:at] if (at := html.rfind("<")) > html.rfind(">") and re.match(r"</?[a-zA-Z!?]", html[at : at + 3]) else html


def style_tree(pages: DataFrame) -> DataFrame:
    """host, path, pages, layout_importance and text_importance (null without text) of every path of every site."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (host, *feature, weight)
                for host, html, weight in zip(batch["host"], batch["html"], batch["weight"], strict=True)
                if isinstance(html, str) and host
                for feature in Page(html).features()
            ]
            yield pd.DataFrame(rows, columns=["host", "path", "kind", "feature", "weight"])

    own = pages.select(
        parts(pages["url"].cast("string"))[0].alias("host"),
        pages["html"].cast("string").alias("html"),
        F.xxhash64(pages["html"].cast("string")).alias("copy"),
    )
    # Pages alike share the weight of one; only those that have copies are joined.
    copies = stored(own.groupBy("host", "copy").agg(F.count("*").alias("n")).where("n > 1"), "page-copies")
    weight = (1 / F.coalesce("n", F.lit(1))).alias("weight")
    weighed = own.join(copies, ["host", "copy"], "left").select("host", "html", weight)
    seen = (
        weighed.mapInPandas(run, "host string, path long, kind int, feature long, weight double")
        .groupBy("host", "path", "kind", "feature")
        .agg(F.greatest(F.round(F.sum("weight"), 3), F.lit(1.0)).alias("n"))
    )
    layout, text = F.col("kind") == 0, F.col("kind") == 1
    sums = seen.groupBy("host", "path").agg(
        F.sum(F.when(layout, F.col("n"))).alias("pages"),
        F.sum(F.when(layout, F.col("n") * F.log("n"))).alias("n_log_n"),
        F.avg(F.when(text, F.log("n"))).alias("log_n"),
    )
    base = F.log(F.greatest("pages", F.lit(2.0)))
    text_importance = F.when(F.col("log_n").isNotNull(), F.greatest(1 - F.col("log_n") / base, F.lit(0.0)))
    return sums.where("pages is not null").select(
        "host",
        "path",
        "pages",
        ((F.log("pages") - F.col("n_log_n") / F.col("pages")) / base).alias("layout_importance"),
        text_importance.alias("text_importance"),
    )


def low_paths(tree: DataFrame) -> DataFrame:
    """host and its paths of low importance, outside and inside an article."""
    own = F.greatest("layout_importance", "text_importance")  # of those that are not null
    importance = (F.col("pages") * own + PRIOR) / (F.col("pages") + PRIOR)
    return (
        tree.where(importance <= LOW)
        .groupBy("host")
        .agg(
            F.collect_list("path").alias("low"),
            F.collect_list(F.when(importance <= LOW_INSIDE, F.col("path"))).alias("low_inside"),
        )
    )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    low = stored(low_paths(style_tree(pages)), "style-tree")
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        pages["html"].cast("string").alias("html"),
    ).withColumn("host", parts(F.col("url"))[0])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [
                Page(text_of(html), _set(a), _set(b)).text()
                for html, a, b in zip(batch["html"], batch["low"], batch["low_inside"], strict=True)
            ]
            out = batch[["page_id", "url"]].copy()
            out["page_id"] = pd.array(out["page_id"], dtype="Int64")
            out["text"], out["n_chars"] = texts, [len(t) for t in texts]
            yield out

    return rows.join(low, "host", "left").mapInPandas(run, "page_id long, url string, text string, n_chars long")


def _set(paths: object) -> frozenset:
    return frozenset(paths) if paths is not None and not isinstance(paths, float) else frozenset()
