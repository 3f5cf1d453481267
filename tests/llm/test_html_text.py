import html
import re

import numpy as np
import pytest

from frostline.llm import html_text
from frostline.llm.html_text import extracted, main_text

CASES = {
    "": "",
    "plain text": "plain text",
    "a <": "a <",
    "cut <b": "cut",
    "<script>var a = '<p>no</p>'": "",
    "<p>one<p>two</div></p>three": "one two three",
    "<article>x &lt;b&gt; &amp;amp; y&nbsp;z</article>": "x <b> &amp; y z",
    "<p>in<b>li</b>ne</p>": "inline",
    "<nav>menu<main><p>text</p></main>": "text",
    "<main><article><header><h1>T</h1></header><p>Words of the page.</p><aside>no</aside>"
    "<div class='cookie-notice'>no</div><form>no<input></form></article><section id=comments><article class=comment>"
    "<p>A comment that is longer than the whole page is.</p></article></section></main><footer>no</footer>":
        "T Words of the page.",
    "<div class=nav><a>x</a></div><div class=content><h1>T</h1><p>One long paragraph of text.</p><p>ok</p>"
    "<p>Another long paragraph of text.</p></div><div class=footer>foot</div>":
        "T One long paragraph of text. ok Another long paragraph of text.",
    "<header>Site</header><article><p>short</p></article><div>outside</div>": "short",
}


@pytest.mark.parametrize("page", CASES)
def test_hand_made_pages(page):
    assert main_text(page) == CASES[page]


LONG = "A sentence of the page's main text, which goes on for a while."
WRAPPED = {
    f"<body><div class='layout has-sidebar'><article><p>{LONG}</p></article></div></body>": LONG,
    f"<div class='page with-search'><div class='has-banner'><article><h1>T</h1><p>{LONG}</p></article></div>"
    "<div class=sidebar><p>more of</p></div></div><div class=foot>foot</div>": f"T {LONG}",
    # The sidebar is longer than the article.
    f"<div class='has-sidebar'><article><p>{LONG}</p></article><div class=sidebar><p>{LONG * 3}</p></div></div>": LONG,
    f"<div class='has-sidebar'><div id=content><p>{LONG}</p><p>{LONG}</p></div><ul class=share><li>x</ul></div>":
        f"{LONG} {LONG}",
    f"<article><h1>T</h1><div class='entry social-ready'><p>{LONG}</p></div></article>": f"T {LONG}",
    f"<div id=content><p>{LONG}</p><p>{LONG}</p></div><article><p>A short teaser.</p></article>": f"{LONG} {LONG}",
    f"<div class='has-related'><div id=content><p>{LONG}</p></div><div class=related><article><p>Teaser.</p></article>"
    "</div></div>": LONG,
    # What is marked rightly stays out, however long.
    f"<div class=post><p>A short post.</p></div><section id=comments><article><p>{LONG}</p></article></section>":
        "A short post.",
    f"<article><p>A short post.</p></article><div class=sidebar><p>{LONG * 9}</p></div>": "A short post.",
    f"<article><p>{LONG}</p><div class=related><article><p>Teaser.</p></article></div></article>": LONG,
}


@pytest.mark.parametrize("page", WRAPPED)
def test_names_of_wrappers_and_short_articles(page):
    assert main_text(page) == WRAPPED[page]


ITEMS = "".join(f"<li><a href='/{n}'>Item {n}</a></li>" for n in range(30))
BAR = "".join(f"<a href='/{n}'>{n}</a><br>" for n in ("Home", "About", "News", "Terms", "Privacy", "Press"))
MENUS = {
    # Menus without a name, before, in and after the text.
    f"<article><h1>T</h1><ul>{ITEMS}</ul><p>{LONG}</p><p>{LONG}</p><p>Yes.</p></article>": f"T {LONG} {LONG} Yes.",
    f"<div><h1>T</h1><p>{LONG}</p><ul>{ITEMS}</ul><p>{LONG}</p><p>Short end.</p><p>Fin.</p></div>":
        f"T {LONG} {LONG} Short end. Fin.",
    f"<div>{BAR}<p>{LONG}</p><p>{LONG}</p>{BAR}</div>": f"{LONG} {LONG}",
    # Links in the text stay, and so does a line of them within it.
    f"<article><p>{LONG} <a href='/x'>More of it</a>.</p><p><a href='/y'>A whole line.</a></p><p>{LONG}</p></article>":
        f"{LONG} More of it. A whole line. {LONG}",
    f"<article><p>{LONG}</p><a name=here><p>Not a link.</p><p>Nor this.</p><p>Or this.</p></article>":
        f"{LONG} Not a link. Nor this. Or this.",
    # A page of links only, and a link that is never closed.
    f"<article><ul>{ITEMS}</ul></article>": " ".join(f"Item {n}" for n in range(30)),
    f"<article><a href='/x'><p>{LONG}</p><p>Short.</p><p>{LONG}</p></article>": f"{LONG} Short. {LONG}",
}


@pytest.mark.parametrize("page", MENUS)
def test_menus_without_a_name(page):
    assert main_text(page) == MENUS[page]


def test_the_ratios_decide(monkeypatch):
    """With constant ratios the menus stay."""
    monkeypatch.setattr(html_text, "smoothed", lambda ratios, sigma: np.ones(len(ratios)))
    assert sum(main_text(page) != text for page, text in MENUS.items()) >= 3


def test_smoothing_equals_brute_force():
    rng = np.random.default_rng(3)
    for sigma in (0.5, 1.0, 2.5):
        for n in (1, 2, 7, 40):
            ratios = rng.random(n) * 100
            reach = int(np.ceil(3 * sigma))
            want = []
            for i in range(n):
                weights = {j: np.exp(-0.5 * ((i - j) / sigma) ** 2) for j in range(max(0, i - reach), min(n, i + reach + 1))}
                want.append(sum(w * ratios[j] for j, w in weights.items()) / sum(weights.values()))
            assert np.allclose(html_text.smoothed(ratios, sigma), want)


def test_pages_of_the_table(spark, small):
    """In these pages the article is marked, so a pattern finds it as well."""
    pages = spark.read.parquet(f"{small}/pages.parquet")
    for r in extracted(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inside = re.sub(r"</?b>", "", re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1])
        blocks = (" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:p|h1|br)>", inside))
        assert r["text"] == " ".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_odd_rows(spark):
    kind = "page_id long, url string, html string, text string, id string"
    rows = [(1, None, None, "t", "i"), (1, "u", "", "t", "i"), (None, "u", "<p>x</p>", "t", "i"),
            (2, "u", "<p>" + "long " * 300_000, "t", "i"), (2, "u", "<div>" * 3000 + "deep", "t", "i")]
    found = sorted(r["n_chars"] for r in extracted(spark.createDataFrame(rows, kind)).collect())
    assert found == [0, 0, 1, 4, 5 * 300_000 - 1]
    assert extracted(spark.createDataFrame([], kind)).count() == 0
