from __future__ import annotations

import time

import pytest

from trackframe.llm.htmltext import extract_pages, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="home sidebar-left">
<header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div id="cookie-notice">We use cookies, as all do, and here is a long notice, with commas.</div>
<div class="layout"><div class="content"><h2>Head&shy;line &amp; more</h2>
<p>First paragraph, with enough words, commas, and length to count as an article paragraph.</p>
<div class="ad">Buy now, cheap, good, best</div>
<p>Second one with a <a href="x">link</a> inside,<br>and a   break &lt;here&gt;.
<p>Third, never closed<ul><li>item one<li>item two</ul>
<form><p>Your mail, please, now, here, at once.</p><input></form></div>
<div class="sidebar"><p>Other news, that are not, of this page, but have commas, many of them, all over, the place.</p></div></div>
<div class="comments"><p>A reader says, with lots of words, that this, and that, is so, and so, and so on, and on.</p></div>
<footer>&copy; all</footer></body></html>"""


def test_article_only():
    assert main_text(PAGE) == ("Head\xadline & more\nFirst paragraph, with enough words, commas, and length to count as an article paragraph.\n"
                               "Second one with a link inside, and a break <here>.\nThird, never closed\nitem one\nitem two")


def test_odd_markup():
    assert main_text("just text") == "just text"
    assert main_text("<article><p><b>one<br><p>two</b></p></article") == "one\ntwo"
    assert main_text("<p>a<!-- <p>b</p> --> c") == "a c"
    assert main_text("<script>only()") == ""
    assert main_text("<div>" * 20000 + "<p>deep, text</p>") == "deep, text"
    assert main_text('<article title="a > b"><p>x</p></article>') == "x"


def test_pages_table(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", ""), (4, "w", "<p>" + "word, " * 20000)]
    got = extract_pages(spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, text string")).collect()
    assert [len(r["text"]) for r in sorted(got, key=lambda r: r["page_id"])] == [len(main_text(PAGE))] * 2 + [0, 0, 6 * 20000 - 1]
    assert extract_pages(spark.createDataFrame([], "page_id long, html string")).count() == 0


@pytest.mark.parametrize("name", ["comment-body", "comment-text", "comment-content", "reply-text", "sidebar-content", "ad-content",
                                  "cookie-notice-text", "newsletter-body", "footer-text", "related-post"])
def test_furniture_with_a_content_word_in_its_name(name):
    aside = f'<div class="{name}"><p>Other words, that are long, and have commas, many, so that they score, too.</p></div>'
    text = "The article, with its own words, and commas, long enough, to be the main text of the page."
    for page in (f'<body><div class="content"><p>{text}</p>{aside}</div></body>', f'<body><article><p>{text}</p></article>{aside}</body>',
                 f'<body>{aside}<div id="main"><p>{text}</p></div></body>'):
        assert main_text(page) == text


@pytest.mark.parametrize("name", ["content has-sidebar", "post widget", "main-content", "entry", "story body with-comments", "layout no-sidebar"])
def test_content_stays(name):
    text = "The article, with its own words, and commas, long enough, to be the main text of the page."
    assert main_text(f'<body><div class="{name}"><p>{text}</p></div></body>') == text


def test_a_page_inside_one_form():
    text = "The article, with its own words, and commas, long enough, to be the main text of the page."
    page = f'<body><form action="/x"><input name="state"><div class="content"><p>{text}</p></div><label>Search</label><button>Go</button></form></body>'
    assert main_text(page) == text


def test_deep_nesting_takes_seconds():
    start = time.process_time()
    assert main_text("<div>" * 100_000 + "<p>deep, text</p>").endswith("deep, text")
    assert main_text("<p><td>" + "<div>x, y" * 30_000 + "<p>deep, text</p>").endswith("deep, text")
    assert main_text("<b>" * 50_000 + "</i>" * 50_000 + "text") == "text"
    assert time.process_time() - start < 20
