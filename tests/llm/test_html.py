"""Main text: reading, minimum cut, whole pages."""

import itertools
import random
import re
from html import unescape

import pytest

from conftest import SF_SMALL
from ingot.llm import html_extract as X
from ingot.llm.common import corpus_table, distinct_sample
from ingot.llm.queries import op2_mincut_html


def test_minimum_cut_against_all_labellings():
    rng = random.Random(1)
    for _ in range(150):
        n = rng.randint(1, 8)
        net = [rng.choice([-1, 1]) * rng.randint(0, 6) * 0.5 for _ in range(n)]
        edges = [(a, b, rng.randint(0, 4) * 0.5) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(kept):
            return sum(max(0, x) if not k else max(0, -x) for x, k in zip(net, kept, strict=True)) \
                + sum(c for a, b, c in edges if kept[a] != kept[b])

        assert abs(cost(X.min_cut(net, edges)) - min(map(cost, itertools.product([False, True], repeat=n)))) < 1e-6


def test_smoothness_carries_a_short_line_in_an_article():
    rows = ["<p>A long paragraph of the article, with commas, and a full stop at its end.</p>"] * 3
    page = "<div><div>" + rows[0] + "<p>Short</p>" + "".join(rows) + "</div><ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul></div>"
    text = X.main_text(page, X.PRIOR)
    assert "Short" in text and "One" not in text and "Two" not in text


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<div id="cookie-notice">We use cookies to improve this site. Accept them all, please, and now.</div>
<header><h1>Site</h1><ul class=menu><li><a href=/a>Aa</a><li><a href=/b>Bb</a></ul></header>
<div id="wrap"><div class="post-content"><h2>The title</h2><p>First paragraph &eacute;t&#233; <b>bo</b>ld &amp; more,
 with\n  words.<p>Second<br>one.<script>x = "</p><p>no</p>"</script><div class="advert">Buy this thing now, it is great, truly.</div>
<form><label>Search</label><input name=q> here, please do, it is quick.</form><noscript>Enable it.</noscript></div>
<aside class="sidebar"><p>A teaser of another text, with commas, and dots.</p></aside>
<section id="comments"><p>I think this is a great text, thank you very much for it.</p></section></div>
<footer><p>&copy; 2024 Us, all rights reserved.</p></footer></body></html>"""


def test_article_without_its_surroundings():
    assert X.main_text(PAGE, X.PRIOR) == "The title First paragraph été bold & more, with words. Second one."


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("<p", ""), ("<!-- open", ""), ("<script>never closed <p>x</p>", ""),
    ("<article>a < b and c</article>", "a < b and c"),
    ("<article><p title='x>y' data-a=it's>q and r</p></article>", "q and r"),
    ("<article><p>one<p>two<li>three</article>", "one two three"),
    ("<main><p hidden>no</p><p style='display: none'>no</p><p>yes</p></main>", "yes"),
    ("<article>" + "<div>" * 2000 + "deep &nbsp; text" + "</div>" * 2000 + "</article>", "deep text"),
    ("<article><h1>x</h1>cut off &am", "x cut off &am"),
    ("<article>fish <svg><text>no</text></svg>&amp;<svg/> chips</article>", "fish & chips"),
    ("<form><article>inside a form</article></form>", "inside a form")])
def test_broken_and_odd_markup(html, text):
    assert X.main_text(html, X.PRIOR) == text


def test_long_sources_take_linear_time():
    X.main_text("<p class='" * 20_000, X.PRIOR)
    X.main_text("<" * 100_000, X.PRIOR)
    assert len(X.main_text("<article>" + "<p>word, and more.</p>" * 20_000 + "</article>", X.PRIOR)) == 16 * 20_000 - 1


@pytest.mark.parametrize("source", [
    "<div>x" * 40_000, "<center>" * 40_000 + "<x-y>z" * 40_000, "<div>" * 40_000 + "</section>x" * 40_000,
    "<b><div>" + "<i>" * 40_000 + "</b>x" * 40_000])
def test_nesting_takes_linear_time(source):
    blocks = X.blocks_of(source)
    assert sum(len(b.text.replace(" ", "")) for b in blocks) == 40_000


def test_subjects_of_an_article_are_no_layout():
    page = """<article><p>Some words, in a first paragraph.</p>
<section id="related-work"><h2 id="legal-status">Related work</h2><p>Others have written about it, and well.</p></section>
<p id="search-results">The search found, in all, ten.</p>
<p>Take <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x{=}2</annotation></math> here.</p>
<section id="comments"><p>Great, thanks a lot, I liked it.</p></section>
<div class="advert"><p>Buy this thing now, it is great, truly, and cheap.</p></div></article>
<div class="related"><p>Another text of this site, which is long, and has commas.</p></div>"""
    assert X.main_text(page, X.PRIOR) == (
        "Some words, in a first paragraph. Related work Others have written about it, and well. "
        "The search found, in all, ten. Take x=2 here.")


def test_sample_is_bounded_by_different_pages(spark):
    rows = [(1, "u", "<article><p>hot</p></article>")] * 300 + [(i, "u", f"<p>page {i}</p>") for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = distinct_sample(df, "html", 20)
    assert len(got) == len(set(got)) == 20 and got == sorted(got)
    assert len(distinct_sample(df, "html", 1000)) == 201
    assert distinct_sample(df.limit(0), "html", 5) == []


def test_query_returns_the_article(spark):
    pages = {r.page_id: r for r in corpus_table(spark, SF_SMALL, "pages").collect()}
    rows = op2_mincut_html(spark, SF_SMALL).collect()
    assert {r.page_id for r in rows} == set(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1]
        want = " ".join(unescape(re.sub(r"<[^>]*(>|$)", "", re.sub(r"<(?:br|/?p|/?h1)>", " ", inner))).split())
        assert (r.text, r.n_chars, r.url) == (want, len(want), pages[r.page_id].url)


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, "t"), (None, "u", PAGE, "t"), (2, "u", "", None), (2, "u", "", None)],
                               "page_id long, url string, html string, text string")
    w = X.train(df)
    got = sorted(((r.page_id or 0, len(r.text), r.n_chars) for r in X.extract(df, w).collect()))
    assert got[1:] == [(1, 0, 0), (2, 0, 0), (2, 0, 0)] and got[0][1] == got[0][2] > 50
    assert X.extract(df.limit(0), X.train(df.limit(0))).count() == 0
    assert (X.fit([]) == X.PRIOR).all()
