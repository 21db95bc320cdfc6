"""Main text: the cut against enumeration, pages with known articles, odd markup."""

import html
import itertools
import random
import re

import pytest

from scanloom.llm import html_text as H
from scanloom.llm import queries


def test_min_cut_is_minimal():
    rnd = random.Random(1)

    def cost(labels, score, edges):
        return sum(max(0, -s) if keep else max(0, s) for keep, s in zip(labels, score)) + sum(w for a, b, w in edges if labels[a] != labels[b])
    for _ in range(500):
        n = rnd.randint(1, 8)
        score = [rnd.choice([-2, -1, -0.5, 0, 0.3, 0.5, 1, 2.5, -H.HARD]) for _ in range(n)]
        edges = [(i, i + 1, 0.6) for i in range(n - 1)] + [(a, b, 0.4) for a, b in itertools.combinations(range(n), 2) if b > a + 1 and rnd.random() < 0.4]
        least = min(cost(x, score, edges) for x in itertools.product([False, True], repeat=n))
        assert abs(cost(H.min_cut(score, edges), score, edges) - least) < 1e-6


def test_query_on_all_pages(spark):
    d = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(d + "/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.queries()["op5_html_mincut"](spark, d).collect()}
    assert set(got) == set(pages)
    for k, page in pages.items():
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", "\n")
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[k].text == "\n\n".join(x for x in parts if x) and got[k].n_chars == len(got[k].text)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body class="has-sidebar">
<header class="site"><a href="/">Home</a><h1>Site</h1></header><nav><a href=1>One</a> <a href=2>Two</a></nav>
<div id="cookie-banner"><p>We use cookies. Please accept all of them now.</p></div>
<div class="wrap">{open}<h1>Title &amp; more</h1><p>First paragraph, with a <a href=x>link</a> &eacute;&#233;
 and   spaces.<p>Second one is not closed<div class="ad">Buy our things now!</div><p>Third<br>line.</p>
<ul><li>Alpha item<li>Beta item</ul><aside>See also this.</aside><form><label>Mail</label><input><button>Send</button></form>{close}
<div class="sidebar"><h3>Popular</h3><p>Ten things you did not know about the moon and the stars.</p></div>
<section id="comments"><h2>Comments</h2><p>A very long comment by a reader who liked the text a lot and says so.</p></section></div>
<footer><p>All rights reserved by the owners of this site, 2020.</p></footer></body></html>"""


@pytest.mark.parametrize("opened,closed", [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-content">', "</div>"), ("<div>", "</div>")])
def test_article_of_many_layouts(opened, closed):
    want = "Title & more\n\nFirst paragraph, with a link éé and spaces.\n\nSecond one is not closed\n\nThird line.\n\nAlpha item\n\nBeta item"
    assert H.extract(PAGE.format(open=opened, close=closed))[0] == want


def test_odd_markup():
    for page, text in [("", ""), ("<", "<"), ("plain text only", "plain text only"), ("a<br>b<p>c", "a b\n\nc"), ("<div>" * 5000 + "x", "x"), ("<script>never closed <p>a", ""), ("<!-- open <p>z</p>", ""),
                       ("<p>1 < 2 & 3 > 2</p>", "1 < 2 & 3 > 2"), ("<p>" + "w " * 300000, ("w " * 300000).strip()), ("</p></div>x", "x"), ("<p>&amp;lt;</p>", "&lt;")]:
        assert H.extract(page)[0] == text


def test_odd_rows(spark):
    rows = [(1, "u", None, 1), (None, None, "<p>Some text here.</p>", 2), (1, "u", "", 3)]
    got = H.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "Some text here.", 15), (1, "", 0), (1, "", 0)]
    assert H.main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def _wrapped(page, start, end):
    import re
    body, stop = re.search(r"<body[^>]*>", page), page.rfind("</body>")
    return page[:body.end()] + start + page[body.end():stop] + end + page[stop:] if body and stop > 0 else start + page + end


def test_wrappers_of_the_whole_page_change_nothing(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]
    kinds = [("<form>", "</form>"), ("<dialog>", "</dialog>"), ('<div role="dialog">', "</div>"), ('<div class="page-widget"><form id="related-main">', "</form></div>")]
    kinds += [(f'<div class="{w}">', "</div>") for w in sorted(H.STRONG)]
    for page in pages:
        want = H.extract(page)[0]
        for kind in kinds:
            assert H.extract(_wrapped(page, *kind))[0] == want, kind


def test_wrappers_around_the_article_and_others():
    p = "<p>The first of some plain sentences of the article, long enough.</p><p>And the second one, which is about as long as it.</p>"
    text = "The first of some plain sentences of the article, long enough.\n\nAnd the second one, which is about as long as it."
    for name in ("elementor-widget", "post-share-enabled", "comments-open", "related-article main"):
        assert H.extract(f'<body><div class="{name}">{p}</div></body>')[0] == text
        assert H.extract(f'<body><nav>Home News</nav><div class="{name}"><article>{p}</article></div><footer>Legal</footer></body>')[0] == text
    side = '<div class="widget"><p>Some other text of the page, of a widget.</p></div>'
    assert H.extract(f"<body><form>{p}{side}</form></body>")[0] == text
    assert H.extract(f"<body><article>{p}</article><div class='comments'>" + "<p>I do not agree with any of this at all, said a reader.</p>" * 30 + "</div></body>")[0] == text
    assert H.extract(f"<body>{p}<form><p>Your name and your address, please, for our letters.</p><input></form></body>")[0] == text


def test_formulas_stay_in_their_paragraph():
    page = "<article><p>Let <math><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation encoding='t'>x=1</annotation></math> hold for all of it.</p></article>"
    assert H.extract(page)[0] == "Let x=1 hold for all of it."
    assert H.extract("<article><p>One <span class='share'>tweet this</span> two three four five.</p></article>")[0] == "One two three four five."


def test_many_marked_elements_take_little_time():
    import time
    page = "<body><form>" + "<div class='widget'><p>a b c d e f g.</p></div>" * 30_000 + "</form></body>"
    began = time.time()
    H.extract(page)
    assert time.time() - began < 30
