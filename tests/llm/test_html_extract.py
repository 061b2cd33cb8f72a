"""Main text of pages: the given pages by their fixed layout, other layouts by hand, broken markup."""

import html
import re
import time

import pytest

from partsnap.llm import html_extract, queries
from partsnap.llm.html_extract import main_text

SF = "/root/testdata/sf0.001"


def by_layout(page):
    """The given pages have one article element of headings and paragraphs."""
    inner = re.search(r"<article>(.*)</article>", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", inner[1]) if inner else []
    lines = [" ".join(html.unescape(re.sub(r"</?b>", "", p).replace("<br>", " ")).split()) for p in parts]
    return "\n".join(x for x in lines if x)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = sorted((r.page_id, r.url, by_layout(r.html), len(by_layout(r.html))) for r in pages.collect())
    got = queries.op12_html_extract(spark, SF)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(tuple(r) for r in got.collect()) == want and all(r[2] for r in want)


BODY = "<p>First, the committee met on a Tuesday; nothing was decided, as usual.</p><h2>Later</h2><p>Short.</p><p>It met again, more briefly, and went home.</p>"
TEXT = "First, the committee met on a Tuesday; nothing was decided, as usual.\nLater\nShort.\nIt met again, more briefly, and went home."


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<body><div class='top-nav'><a href=/>Home</a></div><div id=content><h1>News</h1>{BODY}</div><div class=sidebar><p>About the author, at length, and more.</p></div></body>", f"News\n{TEXT}"),
        (f"<main><h1>T</h1>{BODY}<section id=comments><article><p>Great, really, thanks.</p></article></section></main>", f"T\n{TEXT}"),
        (f"<article>{BODY}<ol class='comment-list'><li class=comment><article class='comment-body'><p>I agree, wholly.</p></article></ol></article>", TEXT),
        (f"<header><h1>Site</h1></header><article><header><h1>T</h1></header>{BODY}<footer>tags</footer><aside>see also</aside></article>", f"T\n{TEXT}"),
        (f"<div class=cookie-notice>We use cookies, as all do.</div><form action=/s><input name=q><button>Go</button></form><div><div>{BODY}</div></div><div class=footer>(c) us</div>", TEXT),
        (f"<form id=aspnet><h1>T</h1>{BODY}</form>", f"T\n{TEXT}"),
        (f"<body class='has-sidebar no-comments'><div class='page with-sidebar'>{BODY}</div></body>", TEXT),
        (f"<article>{BODY}</article><div role=complementary>{BODY}</div><div hidden>{BODY}</div><div style='display: none'>{BODY}</div>", TEXT),
        (f"<table><tr><td><ul><li><a href=1>One</a><li><a href=2>Two</a></ul><td>{BODY}</table>", TEXT),
        (f"<p><a href=1>Home</a> | <a href=2>News</a></p>{BODY}<p><a href=3>Next</a></p>", TEXT),
        (f"<h1>T</h1>{BODY}<article class=teaser><p>Other.</p></article>", f"T\n{TEXT}"),
        (f"<div><section><div class=x>{BODY}</div></section><section><div class=x><p>A second part, of the same, comes here.</p></div></section></div>", f"{TEXT}\nA second part, of the same, comes here."),
        ("<article><h1>Only a title</h1></article><footer>f</footer>", "Only a title"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl></article>", "one\ntwo\na\nb\nc\nd\ne"),
        ("<article><p>a <b>bo</b>ld,<br>next&nbsp;&amp;amp; &lt;x&gt; &copy &#x41;&#66;</p><pre>  x\n  y</pre></article>", "a bold, next &amp; <x> © AB\nx y"),
        ("<article><p>Hi<script>var a='<p>no</p>'</SCRIPT > there<!-- <p>no</p> --><style>p{}</style><noscript>no</noscript>.</article>", "Hi there."),
        ("<title>no</title>Just text, no body.", "Just text, no body."),
        ("<nav>menu</nav><footer>f</footer>", ""),
        ("<p></p> \n<div>&nbsp;</div>", ""),
    ],
)
def test_layouts(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize(
    "page, want",
    [
        ("1 < 2 and 3 <4", "1 < 2 and 3 <4"),
        ("<p>a<b<p>c", "ac"),
        ('<p title="a > b">text</p>', "text"),
        ('<p title="never closed>text</p>', "text"),
        ("<p>x</div></article>y</p>", "xy"),
        ("<p>a</p", "a</p"),
        ("<!--><p>a</p>", "a"),
        ("<p>a</p><!-- no end <p>b</p>", "a"),
        ("<p>İ<script>İİ</script>b</p>", "İb"),
        ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
        ("<![CDATA[a &amp; b]]>", "a &amp; b"),
    ],
)
def test_broken_markup(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page", ["<a " * 100_000, "<div>" * 100_000, "<" * 100_000, "<!--" * 50_000, '<a ="' * 50_000, "<a<" * 50_000 + ">", "<p><!-- x -->" * 20_000, "<li><ul><div>" * 1000 + "</li>" * 50_000])
def test_time_grows_with_the_page(page):
    began = time.time()
    main_text(page)
    assert time.time() - began < 20


def test_rows(spark):
    rows = [(1, "u", None, "x", 1), (2, None, "", "x", 1), (None, "u", f"<article>{BODY}</article>", None, None), (3, "u", "<p>a, b</p>", "x", 1), (3, "u", "<p>a, b</p>", "x", 1), (4, "u", "<p>" + "long, " * 200_000 + "</p>", "x", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = html_extract.extract(df).collect()
    assert sorted(((r.page_id, r.url, r.text, r.n_chars) for r in got if r.page_id != 4), key=repr) == sorted(
        [(1, "u", "", 0), (2, None, "", 0), (None, "u", TEXT, len(TEXT)), (3, "u", "a, b", 4), (3, "u", "a, b", 4)], key=repr
    )
    assert [r.n_chars for r in got if r.page_id == 4] == [1_199_999]
    assert html_extract.extract(df.limit(0)).count() == 0
