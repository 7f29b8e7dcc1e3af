from __future__ import annotations

import itertools
import random
import time

import pytest

from stallbook.llm import html_extract
from stallbook.llm.html_extract import main_text


def cut_value(odds, edges, kept):
    value = sum(o for o, k in zip(odds, kept) if o > 0 and not k)
    value += sum(-o for o, k in zip(odds, kept) if o <= 0 and k)
    return value + sum(w for a, b, w in edges if kept[a] != kept[b])


def test_cut_is_the_smallest_of_all_labellings():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(1, 8)
        odds = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a) if rng.random() < 0.5]
        kept = html_extract.minimum_cut(odds, edges)
        best = min(
            cut_value(odds, edges, k) for k in itertools.product([False, True], repeat=n)
        )
        assert cut_value(odds, edges, kept) == pytest.approx(best)


def test_given_pages_give_the_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in html_extract.extract(pages).collect():
        article = r.html.split("<article>")[1].split("</article>")[0]
        assert r.n_chars == len(r.text) > 0
        assert "©" not in r.text
        plain = html_extract.html.unescape(html_extract.re.sub(r"<[^>]*>", " ", article))
        assert r.text.split() == plain.split()


def test_parts_that_are_not_the_article_go():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
    <div id="cookie-notice"><p>We use cookies. This is a long notice with many words in it.</p></div>
    <header><h1>Site</h1><p>All about it.</p></header><ul class="menu"><li><a href="/">Home</a></ul>
    <div class="layout"><main><article><header><h1>Title</h1></header>
    <p>Fish &amp; chips&#33;<br>cost&nbsp;5 &lt;euro&gt;.<aside>Related</aside>
    <p>A list:<ul><li>one<li><a href="x">two</a></ul><table><tr><td>1<td>2</table>
    <form><label>Mail</label><input></form><script>var x = "<p>no</p>";</script>
    <div class="advert">Buy now, it is cheap and good and you will like it a lot.</div>
    </article></main><div class="sidebar"><p>A long text in the side column, with many words.</p></div>
    </div><section id="comments"><article><p>I think that this is a very good article.</p></article>
    </section><footer>&copy; 2024</footer></body></html>"""
    assert main_text(page) == "Title Fish & chips! cost 5 <euro>. A list: one two 1 2"


def test_pages_without_marked_parts():
    page = """<body><div><a href=a>Home</a> <a href=b>News</a></div><div><h1>The title</h1>
    <p>A long first paragraph of plain words that is the text of a page, as anyone can see.</p>
    <p>Short one.</p><p>Another long paragraph of plain words that is the text of a page too.</p></div>
    <div><ul><li><a href=c>Link one</a></li><li><a href=d>Link two</a></li></ul></div>
    <div>© 2020 Somebody</div></body>"""
    text = main_text(page)
    assert text.startswith("The title A long first") and "Short one." in text
    assert "Home" not in text and "Link" not in text and "2020" not in text


@pytest.mark.parametrize(
    "page", [None, "", " ", "<", "<p", "<article", "&", "<!--", "<script>x", "<a href='", "</p></p>"]
)
def test_broken_pages_do_not_fail(page):
    assert isinstance(main_text(page), str)


def test_unclosed_article_and_deep_and_long_pages():
    assert main_text("<nav><a>x</a></nav><article><p>Text of it") == "Text of it"
    deep = "<div>" * 3000 + "<article><p>Inside.</p>" + "</div>" * 3000
    assert main_text(deep) == "Inside."
    long = "<article>" + "".join(f"<p>number {i}</p>" for i in range(20_000)) + "</article>"
    assert len(main_text(long).split()) == 40_000


def test_rows_and_clashing_columns(spark):
    pages = spark.createDataFrame(
        [(1, "<article>a b</article>", "old"), (1, "<article>a b</article>", "old"), (None, None, "x")],
        "page_id long, html string, text string",
    )
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in html_extract.extract(pages).collect())
    assert got == [(0, "", 0), (1, "a b", 3), (1, "a b", 3)]
    assert html_extract.extract(pages.where("false")).count() == 0


LONG = "A side text of many words that could as well be a paragraph of the article, if it did not stand there. " * 2


@pytest.mark.parametrize("part", ["sidebar", "notice", "banner", "alert", "widget", "masthead", "disclaimer"])
@pytest.mark.parametrize(
    "page",
    [
        "<main><h1>Title</h1><p>First text.</p>{}<p>Second text.</p></main>",
        "<div id=content><div class=post><h1>Title</h1><p>First text.</p><p>Second text.</p></div>{}</div>",
        "<article><h1>Title</h1><p>First text.</p>{}<p>Second text.</p></article>",
    ],
)
def test_side_parts_inside_an_article_go(page, part):
    for side in (f"<p>{LONG}</p>", "<p>Short.</p>", f"<div class='{part}-content'><p>{LONG}</p><p>{LONG}</p></div>"):
        got = main_text(page.format(f"<div class={part}>{side}</div>"))
        assert got == "Title First text. Second text."


def test_only_a_header_with_the_heading_is_of_the_article():
    page = "<article><header{}>{}<p>By somebody.</p></header><p>Text.</p></article>"
    assert main_text(page.format("", "<h2>Title</h2>")) == "Title By somebody. Text."
    assert main_text(page.format(" class=header", "<h2>Title</h2>")) == "Title By somebody. Text."
    assert main_text(page.format("", "")) == "Text."
    assert main_text(page.format(" class=masthead", "<h2>Title</h2>")) == "Text."


def test_an_article_that_stands_in_side_parts_alone_is_kept():
    page = f"<main><div class='text-widget'><p>{LONG}</p></div></main>"
    assert main_text(page) == LONG.strip()


BODY = "<h1>Title</h1><p>First text.</p><p>Second text.</p>"
TEXT = "Title First text. Second text."


@pytest.mark.parametrize(
    "start",
    [
        "<article class='post comments-open'>", "<main class='content nav-visible'>",
        "<article class='share-enabled'>", "<div role=main class='menu'>",
        "<main><article class='post comments-open'>", "<div class='post comments-open'>",
        "<div id=page class='menu-closed'><article>", "<div id=page class='menu-closed'><main>",
        "<div class='skip-links search-open'><div class='nav-open'><div class=content>" + f"<p>{LONG}</p>",
        "<div class='content'>Welcome</div><div id=page class='menu-closed'><article>",
        f"<div class=row><p>{LONG}</p></div><div id=page class='menu-closed'><main>",
    ],
)
def test_outside_words_of_a_state_do_not_lose_the_article(start):
    page = f"""<body>{start}{BODY}<div class="share">Tell it to all the people that you know.</div>
    <div id="comments"><article class="comment-body"><p>{LONG}</p></article></div>"""
    assert main_text(page).endswith(TEXT)


def test_a_wrapper_with_an_outside_word_is_weighed():
    text = f"<h1>Title</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p>"
    want = f"Title {LONG}Short one. {LONG}".strip()
    menu = "<ul class=menu><li><a href=a>Home</a><li><a href=b>News</a></ul>"
    comments = f"<div class=comments><p>{LONG}</p><article><p>{LONG}</p></article></div>"
    assert main_text(f"<div id=page class='menu-closed'>{menu}{text}</div>") == want
    assert main_text(f"{menu}<div class=page>{text}</div>{comments}") == want
    assert main_text(f"<h1>Title</h1><p>Short one.</p><div class=comments><p>{LONG}</p></div>").find("side") < 0
    assert main_text(f"<div id=page class='menu-closed'>{menu}</div>") == ""


def test_articles_inside_an_article_are_comments_if_named_so():
    page = f"<article class=post>{BODY}<article class='comment-body'><p>{LONG}</p></article></article>"
    assert main_text(page) == TEXT


def test_stray_quotes_are_no_markup_in_the_text():
    page = '<article><p title="5" tall">One two three four.</p><p a=\'b\' c\'>Five six.</p></article>'
    assert html_extract.main_text(page) == "One two three four. Five six."


def test_labels_outside_of_forms_are_no_text():
    words = "These are the many plain words of an article that goes on for a while. " * 4
    page = f"<article><p>{words}</p><label>Your name</label><legend>Choose</legend><p>{words}</p></article>"
    text = html_extract.main_text(page)
    assert "Your name" not in text and "Choose" not in text and text.count("plain") == 8


def test_deep_pages_take_time_in_proportion():
    def seconds(n):
        start = time.perf_counter()
        text = html_extract.main_text("".join(f"<div>Some words {i} here." for i in range(n)))
        assert text
        return time.perf_counter() - start

    seconds(500)
    assert seconds(8000) < 16 * max(seconds(2000), 0.05)
