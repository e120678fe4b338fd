import html
import re

import numpy as np
import pytest

from helpers import stored
from lapwise.llm.html import extract, main_text, smoothed, threshold
from lapwise.llm.queries import op6_extract

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "</p><p>no";</script></head><body>
<header><h1>Site name</h1><a href=x>Home</a></header><div id="cookie-notice">We use cookies for everything you do here on this site.</div>
<ul class="menu"><li><a href=a>One</a><li><a href=b>Two</a></ul>
%s<h1>Real title</h1><p>A long paragraph of text that is the article, with <a href=q>a&nbsp;link</a> and
   more &amp; more&#33;</p><p>Short.</p><!-- a comment --><p>Another long paragraph of text which goes on for some time<br>and ends here.%s
<aside>Side</aside><form><input><label>Your name here please</label></form><noscript>Turn it on</noscript>
<div class="comments"><p>I think this is a great article and I have a lot to say about it.</p></div><footer>(c)</footer></body></html>"""
TEXT = (
    "Real title\n\nA long paragraph of text that is the article, with a link and more & more!\n\nShort.\n\n"
    "Another long paragraph of text which goes on for some time and ends here."
)


@pytest.mark.parametrize("begin, end", [
    ("<article>", "</article>"), ("<main>", "</main>"), ('<div id="content">', "</div>"), ("", ""), ('<main><article class="post">', "</article></main>"),
    ("<div><div><article>", "</article></div></div>"), ("<ARTICLE>", "</ARTICLE>"),
])
def test_page(begin, end):
    assert main_text(PAGE % (begin, end)) == TEXT


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("just text", "just text"), ("<p>a<p>b<table><tr><td>c", "a\n\nb\n\nc"),
    ("<article><h1>One line.</h1></article>", "One line."), ("<nav>only</nav><footer>boxes</footer>", ""),
    ("<article><p>a &lt;b&gt; &eacute;&#x41;</p><div class=ad>buy</div><p>c</p></article>", "a <b> éA\n\nc"),
    ("<article><p>one <span class='share'>Share this</span> two</p></article>", "one\n\ntwo"),
    ("<p>unclosed <b>bold <p>next</b></i> more < 3 & <", "unclosed bold\n\nnext more < 3 & <"),
    ("<article><p>a</p><![weird[x]]><p>b</p></article>", None), ("<!doctype><p>x <!-- open", None),
])
def test_small_pages(page, text):
    got = main_text(page)
    assert text is None or got == text


LONG = "A paragraph with quite a few words in it, as the text of an article has, number %d."
BODY = "".join(f"<p>{LONG % i}</p>" for i in range(5))
WANT = "\n\n".join(LONG % i for i in range(5))
MENU = "<nav><a href=a>One</a><a href=b>Two</a></nav>"


@pytest.mark.parametrize("page, text", [
    # Several articles; a teaser beside the body; links without a class in an article.
    (f"<body>{MENU}<article><h2>One</h2>{BODY}</article><article><h2>Two</h2>{BODY}</article></body>", f"One\n\n{WANT}\n\nTwo\n\n{WANT}"),
    (f"<body>{MENU}<article><p>Teaser.</p></article><div>{BODY}</div></body>", WANT),
    (f"<body>{MENU}<article>{BODY}<ul><li><a href=a>Aa</a><li><a href=b>Bb</a><li><a href=c>Cc</a></ul></article></body>", WANT),
])
def test_marks_are_a_hint(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("begin, end", [
    ('<div class="with-sidebar">', "</div>"), ('<article class="post category-social">', "</article>"), ('<article class="tag-cookies">', "</article>"),
    ('<div id="content-and-comments">', "</div>"), ("<form>", "</form>"), ('<div><div class="widget">', "</div></div>"),
])
def test_wrappers_keep_the_article(begin, end):
    assert main_text(f'<body>{MENU}{begin}<div class="post-header"><h1>Title</h1></div>{BODY}<div class="share">Share this</div>{end}</body>') == f"Title\n\n{WANT}"


TALK = ["comments", "comments-area", "post-comments", "comment-list", "replies", "sidebar", "left sidebar"]


@pytest.mark.parametrize("name", TALK)
@pytest.mark.parametrize("title", ["", "<h2>What readers say</h2>", "<h1>Comments</h1>"])
@pytest.mark.parametrize("paragraphs, comments", [(5, 2), (2, 4), (1, 12), (1, 60)])
@pytest.mark.parametrize("shape", [
    "<article>{post}{box}</article>", "<article>{post}</article>{box}", "<div class=post>{post}{box}</div>", "<div>{post}</div>{box}",
    "{box}<article>{post}</article>", "<div class='with-sidebar'><div>{post}</div>{box}</div>", "<div id=content-and-comments>{post}{box}</div>",
])
def test_comments_and_sidebars_go(name, title, paragraphs, comments, shape):
    """Whatever their share of the text, with a heading or without, in the article or beside it."""
    post = "<h2>Title</h2>" + "".join(f"<p>{LONG % i}</p>" for i in range(paragraphs))
    said = "".join(f"<div><b>Reader {i}</b><p>I read all of it and would like to add a few words of my own here, {i}.</p></div>" for i in range(comments))
    page = f"<body>{MENU}{shape.format(post=post, box=f'<div class="{name}">{title}{said}</div>')}<footer>(c)</footer></body>"
    assert main_text(page) == "\n\n".join(["Title", *(LONG % i for i in range(paragraphs))])


LINKS = "".join(f"<li><a href=/{i}>Source number {i}</a></li>" for i in range(5))
SOURCES = "\n\n".join(f"Source number {i}" for i in range(5))


@pytest.mark.parametrize("begin, end", [("<article>", "</article>"), ("<div>", "</div>"), ("<div class=post>", "</div>")])
@pytest.mark.parametrize("page, text", [
    (f"{BODY}<h2>References</h2><ol>{LINKS}</ol>", f"{WANT}\n\nReferences\n\n{SOURCES}"),
    (f"<h1>Title</h1><h2>Contents</h2><ul>{LINKS}</ul>{BODY}", f"Title\n\nContents\n\n{SOURCES}\n\n{WANT}"),
    (f"{BODY}<ul>{LINKS}</ul>{BODY}", f"{WANT}\n\n{SOURCES}\n\n{WANT}"),
])
def test_links_of_the_article_stay(begin, end, page, text):
    assert main_text(f"<body>{MENU}{begin}{page}{end}<ul><li><a href=a>Aa</a><li><a href=b>Bb</a><li><a href=c>Cc</a></ul></body>") == text


@pytest.mark.parametrize("begin, end", [("<div>", "</div>"), ("<article>", "</article>"), ("<section>", "</section>")])
def test_short_lines_stay(begin, end):
    items = "".join(f"<li>it {i}</li>" for i in range(6))
    closing = "".join(f"<p>end {i}</p>" for i in range(4))
    want = [WANT, *(f"it {i}" for i in range(6)), WANT, *(f"end {i}" for i in range(4))]
    assert main_text(f"<body>{MENU}{begin}{BODY}<ul>{items}</ul>{BODY}{closing}{end}<footer>(c)</footer></body>") == "\n\n".join(want)


def test_pages_stripped_of_their_marks(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()
    same = [main_text(r["html"]) == main_text(re.sub("<(/?)article", r"<\1div", r["html"])) for r in rows]
    assert sum(same) >= 0.95 * len(same)
    # Without names as well, what they name can stay; the article must.
    bare = lambda page: re.sub(r" (class|id|role)=(\"[^\"]*\"|'[^']*'|[^ >]+)", "", re.sub("<(/?)article", r"<\1div", page))
    whole = [set(main_text(r["html"]).split("\n\n")) <= set(main_text(bare(r["html"])).split("\n\n")) for r in rows]
    assert sum(whole) >= 0.95 * len(whole)


def test_long_page_is_read_whole():
    paragraphs = [f"Paragraph {i} has quite a few words in it, as text has." for i in range(20_000)]
    page = "<body><nav><a>x</a></nav><article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article></body>"
    assert main_text(page) == "\n\n".join(paragraphs)


def test_smoothing_and_threshold():
    assert np.allclose(smoothed(np.full(7, 3.0)), 3)
    values = smoothed(np.array([2.0, 3, 2, 80, 5, 90, 85, 2, 3, 2]))
    border = threshold(values)
    assert values[4] > border > values[0] and threshold(np.full(5, 9.0)) < 9


def test_query(spark, tmp_path):
    """Blocks of the marked article, found with expressions."""
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in op6_extract(spark, sf).collect():
        article = re.search("<article>(.*)</article>", pages[r["page_id"]], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])
    rows = [(1, None, "u"), (1, None, "u"), (None, "", None), (2, "<p>ok</p>", "u")]
    df = stored(spark, spark.createDataFrame(rows, "page_id long, html string, text string"), tmp_path / "p")
    assert sorted(r["out"] for r in df.withColumn("out", extract("html")).collect()) == ["", "", "", "ok"]
    assert df.limit(0).withColumn("out", extract("html")).collect() == []
