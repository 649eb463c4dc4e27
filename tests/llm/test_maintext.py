import html
import re

import pytest

from opsframe.llm import maintext, queries

LAYOUT = """<!DOCTYPE html><html><head><title>Page, title.</title><style>p{{x:1}}</style>
<script>var t = "<p>not text</p>";</script></head><body class="has-sidebar">
<header><h1>Site name</h1><p>Welcome, reader, to the site. It is good.</p></header>
<div class="cookie-notice"><p>We use cookies, as others do. Accept, or go.</p></div>
<ul class="menu"><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul>
{article}
<div id="sidebar"><p>Side text, which is long, has points. And more, and more.</p></div>
<section class="comments"><h3>Comments</h3><p>I like this, truly. Yes, I do.</p></section>
<form action="/s"><label>Letter</label><p>Sign up, please, for our letter.</p><button>Go</button></form>
<footer>&copy; us, here.</footer></body></html>"""
INNER = """<h1>The title</h1><p class="lead">A first paragraph, of some length; it says a thing.</p>
<p>Short.<p>One <b>bold &amp; <i>odd</b> word&nbsp;here, and an &eacute;.<br>Next   line, too.
<!-- ad --><div class="ad">Buy now, buy cheap. Really!</div><ul><li>An item, one.<li>Two</ul>
<p>A last paragraph of the text, as long as the first; <a href="/x">linked words</a> stay.</p>"""
TEXT = (
    "The title A first paragraph, of some length; it says a thing. Short. One bold & odd word here, "
    "and an é. Next line, too. An item, one. Two A last paragraph of the text, as long as the first; "
    "linked words stay."
)


@pytest.mark.parametrize(
    "around",
    ["<article>{}</article>", "<main>{}</main>", '<div class="post">{}</div>', '<div id="content"><div>{}</div></div>',
     "<div>{}</div>", "<article class='a'><div class=body>{}</div></article>", "<main><article>{}"],
)
def test_article_is_found_in_any_holder(around):
    assert maintext.main_text(LAYOUT.format(article=around.format(INNER))) == TEXT


def test_title_in_the_articles_own_header():
    page = LAYOUT.format(article=f"<article><header><h1>Own</h1><p>By me, today.</p></header>{INNER}</article>")
    assert maintext.main_text(page) == "Own " + TEXT


@pytest.mark.parametrize(
    "source, text",
    [
        (None, ""),
        ("", ""),
        (" \n ", ""),
        ("just text & more", "just text & more"),
        ("<p>a<p>b", "a b"),
        ("a < b and c > d", "a < b and c > d"),
        ("<p>unclosed <b>bold", "unclosed bold"),
        ("<div title='a>b'>x</div>", "x"),
        ('<div title="never closed>x</div>', "x"),
        ("<script>only()</script>", ""),
        ("<script>never closed", ""),
        ("<!-- only -->", ""),
        ("<p>a<!-- b -->c</p>", "ac"),
        ("<p hidden>a</p><p>b, c.</p>", "b, c."),
        ("<form><p>All the page is a form, so this is its text.</p></form>", "All the page is a form, so this is its text."),
    ],
)
def test_awkward_pages(source, text):
    assert maintext.main_text(source) == text


def test_long_pages_stay_linear():
    assert maintext.main_text("<div>" * 20_000 + "x") == "x"
    n = 5_000
    assert maintext.main_text("<p>word, word" * n).count("word, word") == n
    assert maintext.main_text('<a x="' * 2_000).count("<a") == 2_000  # no tag ever ends


@pytest.mark.parametrize("quote", "\"'")
def test_long_quoted_values_end_at_their_quote(quote):
    data = quote + "<p>not text, ever.</p> " * 500 + quote
    page = LAYOUT.format(article=f"<article data-x={data}>{INNER}</article><div data-x={data} class=ad><p>Buy, now.</p></div>")
    assert maintext.main_text(page) == TEXT


def test_broken_quotes_stay_linear():
    n = 50_000
    assert maintext.main_text('<a x=">"' * n + "<p>text")
    assert maintext.main_text("<a x='" + '<b y=">"' * n + "<p>text")


LONG = "<p>Running text, which is long; it has points. And more, and more.</p>" * 8
PLAIN = " ".join(["Running text, which is long; it has points. And more, and more."] * 8)


@pytest.mark.parametrize(
    "article, before",
    [
        (f"<article><h1>Title</h1><p>Lead, text.</p><div class=body>{LONG}</div></article>", "Title Lead, text. "),
        (f"<article><header><h1>Own</h1></header><div class=entry-content>{LONG}</div></article>", "Own "),
        (f"<section id=intro><p>An intro, it is short.</p></section><section id=main>{LONG}</section>", "An intro, it is short. "),
    ],
)
def test_title_and_lead_outside_the_body_element_stay(article, before):
    assert maintext.main_text(LAYOUT.format(article=article)) == before + PLAIN


@pytest.mark.parametrize(
    "article",
    [
        "<div class='content-with-sidebar'><article>{}</article></div>",
        "<div class='layout right-sidebar'><article>{}</article></div>",
        "<div class='cookie-recipes'><article>{}</article></div>",
        "<div class='search-engine-history'><article>{}</article></div>",
        "<article class='related-science'>{}</article>",
        "<div id='comment-culture'><main>{}</main></div>",
        "<div class='banner social'><div class='post'>{}</div></div>",
    ],
)
def test_names_do_not_drop_the_article(article):
    assert maintext.main_text(LAYOUT.format(article=article.format(INNER))) == TEXT


def test_paragraphs_of_an_article_may_be_notices():
    inner = INNER.replace('<p class="lead">', '<p class="notice">')
    assert maintext.main_text(LAYOUT.format(article=f"<article>{inner}</article>")) == TEXT


def test_long_comments_and_teasers_go():
    """Comments that are articles, and longer than the article; teasers; a short page with a long sidebar."""
    comments = "".join(f"<li class=comment><article class=comment-body>{LONG}</article></li>" for _ in range(6))
    teasers = "".join(f"<article><h3><a href=/{i}>Another story, {i}</a></h3></article>" for i in range(5))
    rest = f"<section class=related>{teasers}</section><div id=comments class=comments-area><ol>{comments}</ol></div>"
    for holder in ("<article>{}</article>", "<div class=content-with-sidebar><article>{}</article></div>"):
        assert maintext.main_text(LAYOUT.format(article=holder.format(INNER) + rest)) == TEXT
    short = "<article><p>One sentence only, this.</p></article>"
    page = LAYOUT.format(article=short + f"<div class=sidebar>{LONG}</div>")
    assert maintext.main_text(page) == "One sentence only, this."


def test_paths_sum_their_blocks():
    page = maintext.Page("<article><p>aa.</p><p>bb, cc.</p><h2>t</h2></article>")
    assert [text for _, text, _ in page.blocks] == ["aa.", "bb, cc.", "t"]
    ratios = maintext._fused(page)
    assert ratios[page.blocks[0][0]] == ratios[page.blocks[1][0]] > ratios[page.blocks[2][0]]


def test_frame_with_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "<p>a, b.</p>", "old", 9), (1, "<p>a, b.</p>", "old", 9), (None, None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, html string, text string, n_chars long")
    out = sorted((r.text, r.n_chars) for r in maintext.with_main_text(frame).collect())
    assert out == [("", 0), ("a, b.", 5), ("a, b.", 5)]
    assert maintext.with_main_text(frame.limit(0)).count() == 0


def test_query_returns_the_articles(spark):
    """Held against the text between the article tags of the given pages."""
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in queries.table(spark, folder, "pages").collect()}
    out = queries.op4_maintext(spark, folder).collect()
    assert len(out) == len(pages)
    for r in out:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.DOTALL)[1]
        plain = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert (r.text, r.n_chars, r.url) == (plain, len(plain), pages[r.page_id].url)
