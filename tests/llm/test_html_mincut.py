from __future__ import annotations

import html
import itertools
import re

import pytest

from ledgerlake.llm.html_mincut import _blocks, _content_side, _score, labelled, main_text, op1_html_mincut


def article(page):
    """The text between the article tags of the test pages, block by block."""
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


def test_whole_table_gives_the_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    rows = op1_html_mincut(pages).collect()
    assert len(rows) == len(source)
    for r in rows:
        assert r["text"] == article(source[r["page_id"]])
        assert r["n_chars"] == len(r["text"])


def test_minimum_cut_is_minimal():
    gains, edges = [5, -3, 2, -8, 4, -1], [(0, 1, 2), (1, 2, 4), (2, 3, 1), (3, 4, 3), (4, 5, 2), (0, 5, 1)]

    def cost(side):
        return sum(abs(g) for g, s in zip(gains, side) if (g > 0) != s) + sum(c for a, b, c in edges if side[a] != side[b])

    best = min(cost(side) for side in itertools.product((True, False), repeat=len(gains)))
    assert cost(_content_side(gains, edges)) == best


PARTS = {
    "menu": "<nav><a href=/a>Home</a> <a href=/b>News of the day</a></nav>",
    "header": "<header><div>My site, the place for long stories.</div></header>",
    "notice": '<div id="cookie-notice">We use cookies to make this site work for you. Accept them all.</div>',
    "advert": '<div class="ad-slot"><p>Buy now, the offer ends today, it really does.</p></div>',
    "sidebar": '<div class="right sidebar"><p>Popular stories that others read this week.</p></div>',
    "form": "<form><label>Your mail address, please.</label><textarea>typed text</textarea></form>",
    "code": "<script>var a = '<p>not text</p>';</script><style>p { color: red }</style><noscript>Enable it</noscript>",
    "comment": "<!-- <p>hidden comment</p> -->",
    "readers": '<section class="comments"><article class="comment"><p>I liked this article very much, thank you all.</p></article></section>',
    "footer": "<footer>&copy; 2024 My site. All rights are reserved by us.</footer>",
    "hidden": '<div style="display: none">Unseen words that no reader of this page gets.</div>',
}
MAIN = "<h2>A title &amp; more</h2><p>First  paragraph,\n with <b>bold</b> words &eacute;t <i>caf&#233;</i>.<p>Second one&nbsp;ends<br>here. <ul><li>An item</li><li>Another</ul>"
WANT = "A title & more\nFirst paragraph, with bold words ét café.\nSecond one ends here.\nAn item\nAnother"


@pytest.mark.parametrize("name", PARTS)
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", '<div class="post-content">{}</div>'])
@pytest.mark.parametrize("before", [True, False])
def test_boilerplate_goes_and_the_article_stays(name, wrap, before):
    body = wrap.format(MAIN)
    page = f"<html><head><title>T</title></head><body class='has-sidebar'>{PARTS[name] + body if before else body + PARTS[name]}</body></html>"
    assert main_text(page) == WANT


REAL = "<h1>Storm over the harbour</h1><p>The storm came in the night, and the boats were torn from their lines.</p><p>By noon the water had fallen again, and people went out to look for what was left of the pier.</p><p>Nobody was hurt, the mayor said.</p>"
REAL_WANT = "\n".join(re.sub("<[^>]+>", "", b) for b in re.findall(r"<(?:h1|p)>.*?</(?:h1|p)>", REAL))
AROUND = {
    "form": "<form action='/x'><nav><a href=/a>Home</a> <a href=/b>News</a></nav>{}<footer>All rights are reserved by us.</footer></form>",
    "page builder": '<div class="elementor-widget elementor-widget-text">{}</div><aside><p>Popular stories that others read this week.</p></aside>',
    "banner page": '<div id="page" class="banner-page"><div class="cookie-notice">We use cookies on this site.</div>{}</div>',
    "modal": '<div class="modal-body">{}</div><div class="comments"><p>I liked this very much, and I would like to read far more of it, thank you all for the work on it.</p></div>',
    "open nav": "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul><div>{}</div>",
}


@pytest.mark.parametrize("inner", ["{}", "<article>{}</article>", '<div class="post">{}</div>'])
@pytest.mark.parametrize("name", AROUND)
def test_marked_wrappers_of_a_page_keep_its_text(name, inner):
    assert main_text(f"<html><body>{AROUND[name].format(inner.format(REAL))}</body></html>") == REAL_WANT


@pytest.mark.parametrize("head", ['<header class="entry-header">{}</header>', '<div class="post-header">{}</div>', "<header>{}</header>"])
@pytest.mark.parametrize("body", ["<article>{}</article>", '<div class="post-content">{}</div>'])
def test_the_header_of_an_article_keeps_its_title(head, body):
    title, rest = REAL.split("</h1>")
    page = "<header><div>My site, the place for long stories.</div></header>" + body.format(head.format(title + "</h1>") + rest)
    assert main_text(page) == REAL_WANT


def test_inline_elements_never_split_a_block():
    page = '<article><p>Rain fell, <a class="related" href=/r>as told before</a>, for two days on end.</p><p>Then it stopped at last.</p></article>'
    assert main_text(page) == "Rain fell, as told before, for two days on end.\nThen it stopped at last."
    # An inline element around the whole block does mark it.
    page = '<article><p>Rain fell for two days on end.</p></article><span class="advert">Buy now, the offer ends today.</span>'
    assert main_text(page) == "Rain fell for two days on end."


@pytest.mark.parametrize("longer", [1, 30])
def test_long_comments_and_footers_are_no_page(longer):
    """Boilerplate may hold more words than the article; its names still count."""
    words = "I read all of this and I liked it very much, thank you for the work. " * longer
    for box in ('<section class="comments"><article><p>{}</p></article></section>', "<footer><p>{}</p></footer>", '<div class="sidebar"><p>{}</p></div>', '<div id="cookie-notice"><p>{}</p></div>'):
        for inner in ("<article>{}</article>", "<div>{}</div>"):
            assert main_text(f"<body>{inner.format(REAL)}{box.format(words)}</body>") == REAL_WANT


def test_the_cut_overrules_single_scores():
    """A short line between sentences scores below zero by itself and stays by its neighbours."""
    lines = ["The storm came in the night, and the boats were torn from their lines.", "Ten boats", "By noon the water had fallen, and people went out to look."]
    page = "<body><div><p>" + lines[0] + "</p><div>" + lines[1] + "</div><p>" + lines[2] + "</p></div></body>"
    blocks = _blocks(page)
    assert [_score(t, b, False) > 0 for t, b in blocks] == [True, False, True]
    assert main_text(page) == "\n".join(lines)


def test_deep_and_broken_nesting_is_linear():
    page = "<div class=nav>" * 30000 + "words in the depth of it" + "<form><p>" * 30000
    assert main_text(page) == ""


def test_odd_pages(spark):
    long = "<article>" + "<p>Words of a very long page, again and again.</p>" * 20000 + "</article>"
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "plain words only, without any markup at all."), (4, "u", "<p>open <b>and never closed, cut off <a hr"), (5, "u", "<script>only code"), (6, "u", long), (6, "u", long), (7, "u", "<div><!-- never closed"), (8, "u", "a < b and b > c is a plain sentence of words.")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text")
    got = {r["page_id"]: r["text"] for r in op1_html_mincut(df).collect()}
    assert got[1] == got[2] == got[5] == got[7] == ""
    assert got[3] == "plain words only, without any markup at all."
    assert got[6].count("\n") == 19999
    assert got[8] == "a < b and b > c is a plain sentence of words."
    assert op1_html_mincut(df).count() == len(rows)
    assert op1_html_mincut(df.limit(0)).collect() == []
    assert labelled("") == []
