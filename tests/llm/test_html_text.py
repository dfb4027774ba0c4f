import pytest

from lenstrail.llm.html_text import extract, main_text

PARAGRAPH = "This is a long paragraph of the article, with commas, and stops. It goes on for a while, as articles do."
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><article>no</article>";</script></head>
<body><header><h1>Site</h1><a href="/">Home</a></header><nav><ul><li><a href="/a">Menu, one.</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies, as all do. Accept, please.</p></div>
<!-- <p>hidden</p> --><div id="main"><article><h1>A  &amp;
title</h1><p>{PARAGRAPH}<p>Short.<p>Second &eacute;&#233; <b>bold</b>, <a href="x">linked</a> words&nbsp;here. {PARAGRAPH}</p>
<div class="advert">Buy now, it is cheap. Really, buy it now.</div><aside>See also: this, that.</aside>
<form><label>Name</label><input name=a><button>Go</button></form><ul><li>First item, of a list.<li>Second item.</ul>
<section class="comments"><p>{PARAGRAPH}</p></section></article></div>
<div class="sidebar"><p>{PARAGRAPH}</p></div><footer>&copy; 2024, all rights.</footer></body></html>"""


def test_article_without_furniture():
    assert main_text(PAGE).split("\n") == [
        "A & title",
        PARAGRAPH,
        "Short.",
        f"Second éé bold, linked words here. {PARAGRAPH}",
        "First item, of a list.",
        "Second item.",
    ]


@pytest.mark.parametrize("page", [None, "", "   ", "<html></html>", "<script>x", "<!-- a"])
def test_pages_without_text(page):
    assert main_text(page) == ""


def test_broken_markup():
    assert main_text(f"<body><article><p>{PARAGRAPH}<p><b>{PARAGRAPH} x &am").split("\n")[1].startswith(PARAGRAPH)
    assert main_text(f"<div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</di") == f"{PARAGRAPH}\n{PARAGRAPH}"
    assert main_text(f"<article><p>a < b and c > d. {PARAGRAPH}</p></article>").startswith("a < b and c > d.")
    assert main_text("plain words, no tags.") == "plain words, no tags."


def test_divs_only():
    nav = "".join(f"<div class=menu><a href=/{i}>Link {i}</a></div>" for i in range(8))
    body = "".join(f"<div>{PARAGRAPH} {i}</div>" for i in range(4))
    assert main_text(f"<body>{nav}<div class=content>{body}</div><div class=footer>Small print.</div></body>").count("\n") == 3


def test_rows(spark):
    rows = [(1, "u", PAGE, 5), (None, None, None, 6), (2, "v", "<p>" + "word " * 200_000 + "</p>", 7), (1, "u", PAGE, 5)]
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int"))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id or 0, r.n_chars, len(r.text)) for r in out.collect()))
    assert got == [(0, 0, 0), (1, got[1][1], got[1][1]), (1, got[1][1], got[1][1]), (2, 999_999, 999_999)]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("inner", ["section", "blockquote", "div"])
@pytest.mark.parametrize("outer", ["article", "div"])
def test_short_blocks_beside_long_ones(outer, inner):
    page = f"<body><{outer}><h1>T</h1><p>Lead.</p><{inner}><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></{inner}><p>End.</p></{outer}></body>"
    assert main_text(page).split("\n") == ["T", "Lead.", PARAGRAPH, PARAGRAPH, "End."]


@pytest.mark.parametrize("name", ["content with-sidebar", "post no-comments", "search-result", "social-policy", "widget"])
def test_names_that_hold_the_content(name):
    page = f"<body><div class=site-footer><p>{PARAGRAPH}</p></div><div class='{name}'><h1>T</h1><p>{PARAGRAPH}</p><p>{PARAGRAPH} x</p></div></body>"
    assert main_text(page).split("\n") == ["T", PARAGRAPH, f"{PARAGRAPH} x"]
