import random
import time

import pytest

from tidemark.llm import html_text as ht

P1 = "First paragraph of text, with several commas, and it is long enough to be scored highly indeed."
P2 = "Second paragraph, which goes on for a while as well, so that it passes some points upwards, too."
MENU = "<ul><li><a href='/a'>Home</a></li><li><a href='/b'>About us, and more</a></li><li><a>Contact</a></li></ul>"

PAGES = {
    f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav>{MENU}</nav><!-- ad --><div class=ad>Buy, buy, buy.</div><article><h1>Head</h1><p>{P1}</p><p>{P2}</article><footer>&copy; us</footer>": ["Head", P1, P2],
    f"<div id=menu>{MENU}</div><div class='side-bar sidebar'><p>{P2}</p></div><div id=content><h1>Head</h1><div class=body><p>{P1}<p>A &amp; B <b>bold</b>&nbsp;more<br>next</div><section id='comments'><p>{P2}</p></section></div>": ["Head", P1, "A & B bold more", "next"],
    f"<main><header><h1>Head</h1><span>by someone</span></header><p>{P1}</p><form><input><p>{P2}</p></form><aside><p>{P2}</p></aside><p>{P2}</p></main>": ["Head", P1, P2],
    f"<header><p>{P2}</p></header><div><p>{P1}</p><p>{P2}</p>{MENU}</div>": [P1, P2],
    f"<body><div role='alert'>We use cookies, yes.</div><div class='cookie-notice'><p>{P2}</p></div><div class='post'><h2>Head</h2><p>{P1}</p><blockquote>{P2}</blockquote></div><div style='display:none'><p>{P2}</p></div>": ["Head", P1, P2],
    f"<article><p><b>{P1}<br><p>{P2}</b></p></article><footer>x</footer>": [P1, P2],
    f"<div class='page-header header'><p>{P2}</p></div><div class=post><div class='post-header'><h1 class='header'>Head</h1></div><p>{P1}</p><p>{P2}</p></div>": ["Head", P1, P2],
    f"<div class='popular-science'><h1>Head</h1><p>{P1}</p><p>{P2}</p></div>": ["Head", P1, P2],
    f"<div class='popular'><h1>Head</h1><p>{P1}</p></div><div class='comments'><p>{P2}</p></div>": ["Head", P1],
    f"<div class='has-sidebar'><h1>Head</h1><p>{P1}</p><div class='sidebar'><p>{P2}</p></div></div>": ["Head", P1],
    f"<div class='search-results-page'><p>{P1}</p>" + f"<p>{P2}</p>" * 9 + f"</div><div class='share-bar'>Tell a friend, or two.</div><div class='intro'><p>{P1}</p></div>": [P1] + [P2] * 9,
    f"<div class='comments'><p>{P2}</p></div><div hidden><p>{P1}</p></div>": [],
    f"<nav>{MENU}</nav><div class='cookie-notice'><p>{P2}</p></div><div class='comment-list'><p>{P1}</p></div><div id='site-footer'><p>{P1}</p></div>": [],
    f"<i><div><p>{P1}</i></p></div>{P2}": [P1, P2],
    f"<article><ul><li><p>{P1}<ul><li>in</ul></li><li><p>{P2}</p></ul></article>": [P1, "in", P2],
    "<p>Just one.": ["Just one."],
    "plain text only": ["plain text only"],
    "<p title='a>b'>q</p><a <b>": ["q"],
    "<article><p>one<script>if(a<b){x='</p>'}</script>   two\n\t three</p><p></p><p> &#233;&lt;&amp </p></article>": ["one two three", "é<&"],
    "": [],
    "<html><head><title>x</title></head><body></body></html>": [],
    "<!-- <p>no</p>": [],
}


@pytest.mark.parametrize("html", PAGES)
def test_extract(html):
    assert ht.extract(html) == PAGES[html]


def test_broken_markup_of_any_kind():
    rng = random.Random(3)
    parts = ["<p>", "</p>", "<div class='", "'", '"', "<", ">", "</", "<b>", "</div>", "<!--", "-->", "text, ", "&am", "&#x", "<script>", "</script>", "<li>", "<table><tr><td>", "</ul>", "=", "<a href=x>", "\x00", "é"]
    for _ in range(3000):
        html = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        for block in ht.extract(html):
            assert block == " ".join(block.split()) != ""


def test_large_pages_take_linear_time():
    n = 100_000
    began = time.process_time()
    for html in ("<b>" * n + "</i>" * n, "<i><div>" + "<b>" * n + "</i>" * n, "<div>" + "<b>" * n + "<div></div>" * n, "<head>" + "<b>" * n + "<body>" * n, "<article>" + "<b>" * n + "<header></header>" * n, "<table>" + "<b>" * n + "<li>" * n + "</td>" * n):
        ht.extract(html + "x" * 30)
    assert time.process_time() - began < 6 * 2 * 4  # each some seconds at most; by the square they took hours
    for html in ("<div>" * 30_000 + "x", '<a "' * 50_000, "<" * 300_000, "<p>a," * 50_000, "<b>" * 20_000 + "<p>t</p>" * 2_000, "<!--" * 50_000):
        ht.extract(html)
    assert ht.extract("<article>" + f"<p>{P1}</p>" * 3000 + "</article>") == [P1] * 3000


def test_generated_pages(spark, data):
    import html as entities
    import re

    pages = spark.read.parquet(f"{data}/pages.parquet")
    got = {r.page_id: r for r in ht.op10_tree_scoring(spark, data).collect()}
    for r in pages.collect():
        body = r.html[r.html.find("<article>") + 9 : r.html.find("</article>")].replace("<b>", "")
        blocks = [" ".join(entities.unescape(x).split()) for x in re.split(r"<[^>]*>", body)]
        text = "\n".join(b for b in blocks if b)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (text, len(text), r.url)


def test_edges(spark):
    rows = [(1, None, None, "t"), (1, None, None, "t"), (None, "u", "<p>null id</p>", "t"), (3, "u", "<p>" + "long, " * 50_000, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((str(r.page_id), r.n_chars) for r in ht.extracted(df).collect()))
    assert got == [("1", 0), ("1", 0), ("3", 299_999), ("None", 7)]
    assert ht.extracted(df.limit(0)).count() == 0
