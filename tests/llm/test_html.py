from __future__ import annotations

from newsmart.llm import html
from newsmart.llm.html import Page

CASES = [
    ("<article><h1>T&nbsp;1</h1><p>a<b>b</b> c&amp;lt;<br>d</article>", "T 1 ab c&lt; d"),
    ("<nav>m</nav><header>h</header><main><p>x</p><aside>s</aside></main><footer>f</footer>", "x"),
    ("<article><p>x<div class='ad-box'>buy</div><form>f<input></form><p>y</article>", "x y"),
    ("<article><p>x</p><section class=comments><article class=comment>c</article></section></article>", "x"),
    ("<body><div id='cookie-notice'>ok</div><div class='content'><p>x</div><p>y</body>", "x"),
    ("<body class='has-sidebar'><p>x<script>'</p>'</script><style>p{}</style><!-- c --><p>y", "x y"),
    ("<article><p><b>one<br><p>two</p><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "one two a b c d"),
    ("<article><p>shadow<p class='header-like shadow'>x", "shadow"),
    ("<p>cut off &am", "cut off &am"),
    ("<article><p>cut</p><p", "cut"),
    ("<article><p>cut</p><!-- rest", "cut"),
    ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ("<p hidden>h</p><p style='display: none'>n</p>plain", "plain"),
    ("", ""),
    ("</div></p>x", "x"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
]


def test_pages():
    for source, text in CASES:
        assert Page(source).text() == text, source


def test_site_furniture_goes_and_articles_stay(spark):
    """A box without any telling name repeats on each page of a site."""
    box, line = "<div class='q1'>Call us now</div>", "<p>The same line on each page.</p>"
    rows = [(i, f"https://a.org/{i}", f"<body>{box}<p>text {i} of its own</p>{line}</body>") for i in range(12)]
    rows += [(100 + i, f"https://b.org/{i}", f"<article><h1>Same</h1>{line}</article>") for i in range(12)]
    rows += [(200, "https://c.org/", f"<body>{box}<p>alone</p></body>"), (201, None, "<p>x</p>"), (None, "u", None), (200, "https://c.org/", f"<body>{box}<p>alone</p></body>")]
    frame = spark.createDataFrame([(*r, "h", 1, None) for r in rows], "page_id long, url string, html string, host string, path int, low string")
    got = {r.page_id: (r.text, r.n_chars) for r in html.extract(frame).collect()}
    for i in range(12):
        assert got[i][0] == f"text {i} of its own The same line on each page."
        assert got[100 + i][0] == "Same The same line on each page."
    assert got[200] == ("Call us now alone", 17)
    assert got[201] == ("x", 1)
    assert got[None] == ("", 0)
    assert html.extract(frame).count() == len(rows)
    assert html.extract(frame.limit(0)).count() == 0


def test_importance_is_entropy(spark):
    rows = [(i, "https://a.org/", f"<p>{'same' if i < 4 else i}</p><!-- {i} -->") for i in range(8)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    tree = html.style_tree(frame).where("text_importance is not null").collect()
    # Texts on 4, 1, 1, 1 and 1 of 8 pages: the mean of log(n) / log(8) is (2 / 3) / 5.
    assert [(r.pages, round(r.text_importance, 6)) for r in tree] == [(8, round(1 - 2 / 15, 6))]


PAGES = "page_id long, url string, html string, weight int, copy string, n int"


def run(spark, pages):
    frame = spark.createDataFrame([(i, *p, 1, "x", 2) for i, p in enumerate(pages)], PAGES)
    return {r.page_id: r.text for r in html.extract(frame).collect()}


def site(template, n=12, host="a.org"):
    return [(f"https://{host}/{i}", template.replace("{i}", str(i))) for i in range(n)]


WHOLE = [
    ("<body><div class=x><p>Intro line.</p><p>own {i}</p></div></body>", "Intro line. own {i}"),
    ("<div id=post-{i} class=entry><p>own {i}<p>more {i}</div>", "own {i} more {i}"),
    ("<article><p><b>Question:</b> own {i}</p></article>", "Question: own {i}"),
    ("<main><div>Ingredients</div><p>own {i}</p></main>", "Ingredients own {i}"),
    ("<article><div>text</div></article>", "text"),
    ("<body><p>One page under many addresses.</p></body>", "One page under many addresses."),
    ("<body><p><b>Question:</b> own {i} <a href=x>more</a></p></body>", "Question: own {i} more"),
    ("<body><div><div><div>own {i} deep</div></div></div></body>", "own {i} deep"),
]


def test_text_is_never_lost_to_repetition_around_it(spark):
    for n in (1, 7, 8, 9, 12):
        pages = [p for k, (template, _) in enumerate(WHOLE) for p in site(template, n, f"h{k}.org")]
        got = run(spark, pages)
        wanted = [text.replace("{i}", str(i)) for _, text in WHOLE for i in range(n)]
        assert [got[i] for i in range(len(pages))] == wanted


#: Furniture without a telling tag, role, class or id, and the text that stays.
UNNAMED = [
    ("<div class=a1><div>Acme</div><div>Home</div></div><div class=b2><p>own {i}</p></div><div class=c3>Since 1990</div>", "own {i}"),
    ("<table><tr><td class=l><p>Start</p><p>About</p></td><td class=r><h1>T {i}</h1><p>own {i}</p></td></tr></table>", "T {i} own {i}"),
    ("<div class=q><ul><li>One</li><li>Two</li></ul></div><p>first {i}</p><p>second {i}</p>", "first {i} second {i}"),
    ("<div class=k9><span>Call</span> <b>us</b></div><section class=z><p>own {i}</p></section>", "own {i}"),
    ("<article><p>own {i}</p><div class=t7><div>Like it</div><div>Pass it on</div></div></article>", "own {i} Like it Pass it on"),
    ("<div class=m4><a href=/>Top</a><a href=/b>Back</a></div><div class=w>own {i}<br>two {i}</div>", "own {i} two {i}"),
]


def test_unnamed_furniture_goes(spark):
    pages = [p for k, (template, _) in enumerate(UNNAMED) for p in site(template, 12, f"u{k}.org")]
    got = run(spark, pages)
    wanted = [text.replace("{i}", str(i)) for _, text in UNNAMED for i in range(12)]
    assert [got[i] for i in range(len(pages))] == wanted  # recall and precision of 1
    # Inside an article it takes many pages to tell.
    many = run(spark, site(UNNAMED[4][0], 120))
    assert many[7] == "own 7"


def test_pages_alike_count_once(spark):
    """A page read a hundred times is no evidence against its text."""
    pages = site("<body><div>Head</div><p>own {i}</p></body>", 2) + [("https://a.org/0", "<body><div>Head</div><p>own 0</p></body>")] * 100
    assert run(spark, pages)[50] == "Head own 0"


def test_one_huge_text_and_many_children(spark):
    huge = "word " * 400_000
    got = run(spark, [("https://a.org/1", f"<p>{huge}</p>"), ("https://a.org/2", "<div>" + "<p>x</p>" * 20_000 + "</div>")])
    assert got[0] == huge.strip() and got[1] == " ".join(["x"] * 20_000)


def test_importances_equal_a_direct_computation(spark):
    import math
    import random
    from collections import Counter, defaultdict

    draw = random.Random(5)
    sources = [
        "<body>" + "".join(f"<div><p>{draw.choice('abc')}</p></div>" for _ in range(draw.randrange(1, 4))) + "</body>" for _ in range(40)
    ]
    frame = spark.createDataFrame([(i, "https://a.org/", s, 1, "x", 2) for i, s in enumerate(sources)], PAGES)
    seen, counts = defaultdict(Counter), defaultdict(int)
    for source in set(sources):
        for path, kind, feature in Page(source).features():
            seen[path, kind][feature] += 1
            counts[path] += kind == 0
    for r in html.style_tree(frame).collect():
        m = counts[r.path]
        layouts, texts = seen[r.path, 0], seen.get((r.path, 1))
        base = math.log(max(m, 2))
        entropy = -sum(n / m * math.log(n / m) for n in layouts.values()) / base
        assert r.pages == m and abs(r.layout_importance - entropy) < 1e-6
        if texts:
            mean = sum(map(math.log, texts.values())) / len(texts)
            assert abs(r.text_importance - max(1 - mean / base, 0)) < 1e-6
        else:
            assert r.text_importance is None
