import html
import itertools
import random
import re

import numpy as np
import pytest

from newsloom.llm import extract as E

MODEL = (np.zeros(E.N_FEATURES), 0.0)


def text(page):
    return E.main_text(page, *MODEL)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{a:b}</style><script>var t="</p>";x()</script></head><body>
<header class=top><a href=/>Site</a></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div id="cookie-notice">We use cookies.</div><div class="ad banner">Buy &amp; save</div>
<article><h1>Title &lt;one&gt;</h1><p><b>First para&shy;graph,
  two   lines.<br><p>Second &copy &amp;c. &#146;q&#x2019; <a href="x">link</a> end.</p><aside>Related</aside>
<form><p>Your mail</p><button>Send</button></form><div class="ad">Buy</div><ul><li>Item one<li>Item two</ul>
<table><tr><td>x</td><td>y</td></tr></table><p hidden>no</p><p style="display: none">no</p></article>
<section class="comments"><article><p>I disagree.</p></article></section><!-- <p>no</p> -->
<footer>&copy; me</footer></body></html>"""


def test_page_with_everything():
    assert text(PAGE) == (
        "Title <one>\nFirst para­graph, two lines.\nSecond © &c. ’q’ link end.\nItem one\nItem two\nx\ny"
    )


@pytest.mark.parametrize("page,want", [
    ("", ""), ("<p>", ""), ("<nav>a</nav>", ""), ("<article>a<!-- x", "a"), ("<article>a<script>b", "a"),
    ("<article><p>a > b < c</p></article>", "a > b < c"), ("<article><p title='x>y'>a</p>", "a"),
    ("<main><p>a</p></div></main>", "a"), ("<article>&nbsp; a &nbsp;</article>", "a"), ("<article>a&am</article>", "a&am"),
    ("<article>" + "<div>" * 500 + "deep" + "</div>" * 500 + "</article>", "deep"),
])
def test_broken_pages(page, want):
    assert text(page) == want


def cut_cost(costs, edges, label):
    own = sum(max(c, 0) for c, on in zip(costs, label) if not on) + sum(max(-c, 0) for c, on in zip(costs, label) if on)
    return own + sum(w for i, j, w in edges if label[i] != label[j])


def test_minimum_cut_equals_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 8)
        costs = [rng.randint(-6, 6) / 4 for _ in range(n)]
        edges = [(i, j, rng.randint(1, 6) / 4) for i in range(n) for j in range(i) if rng.random() < 0.5]
        best = min((round(cut_cost(costs, edges, label), 6), sum(label)) for label in itertools.product([False, True], repeat=n))
        got = E.minimum_cut(costs, edges)
        assert (round(cut_cost(costs, edges, got), 6), sum(got)) == best


def test_long_undecided_page_is_fast():
    n = 3000
    costs = [0.6 if i % 3 else -0.7 for i in range(n)]
    label = E.minimum_cut(costs, [(i, i + 1, 1.0) for i in range(n - 1)])
    assert len(label) == n


def test_smoothness_fills_gaps():
    assert E.minimum_cut([2.0, -0.5, 2.0], [(0, 1, 1.0), (1, 2, 1.0)]) == [True, True, True]
    assert E.minimum_cut([2.0, -2.5, 2.0], [(0, 1, 1.0), (1, 2, 1.0)]) == [True, False, True]


def test_without_containers_the_learned_text_decides(spark):
    body = "".join(f"<p>This is a long paragraph, number {i}, with several words in it. And more of them.</p>" for i in range(6))
    links = "".join(f'<li><a href="/{i}">Go {i}</a></li>' for i in range(8))
    named = [(i, f"<nav><ul>{links}</ul></nav><article>{body}</article>") for i in range(20)]
    weights, constant = E.learn(spark.createDataFrame(named, "page_id long, html string"))
    got = E.main_text(f"<div><ul>{links}</ul></div><div>{body}</div>", weights, constant)
    assert got.count("\n") == 5 and "Go" not in got


def test_columns_nulls_and_repeats(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, PAGE, "x"), (3, PAGE, "x"), (None, "<article>" + "é " * 50000, "x")]
    df = E.extract(spark.createDataFrame(rows, "page_id long, html string, text string"))
    got = {(r["page_id"], r["text"], r["n_chars"]) for r in df.collect()}
    assert df.columns == ["page_id", "text", "n_chars"] and df.count() == 5
    assert (1, "", 0) in got and (2, "", 0) in got and (None, " ".join(["é"] * 50000), 99999) in got
    assert E.extract(spark.createDataFrame([], "page_id long, html string")).collect() == []


def test_pages_of_the_table(spark):
    """The generated pages keep their text in one article of paragraphs."""
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = E.query(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search("<article>(.*)</article>", pages[r["page_id"]]["html"], re.S)[1]
        parts = [re.sub("<[^>]*>", "", x) for x in re.split("<p>|</p>|<br>|<h1>|</h1>", inner)]
        want = [" ".join(html.unescape(x).split()) for x in parts]
        assert r["text"] == "\n".join(x for x in want if x) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("inner,want", [
    ('<p>a <svg class="i"/> b</p><p>rest</p>', "a b\nrest"),
    ('<p>a <svg class="i"><path d="x"/><title>t</title></svg> b</p><p>rest</p>', "a b\nrest"),
    ("<p>a <svg> b</p><p>rest</p>", "a b\nrest"),
    ("<p>a <button>Send</button> b</p><p>rest</p>", "a b\nrest"),
    ("<p>a</p><button>Send<p>rest</p>", "a\nSend\nrest"),
    ("<button>One<p>a</p><button>Two</button><p>rest</p>", "One\na\nrest"),
    ("<p>a</p><select><option>x<option>y</select><p>rest</p>", "a\nrest"),
    ("<p>if <math><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow></math> then</p><p>rest</p>", "if x=1 then\nrest"),
    ("<p>if <math/> then</p><p>rest</p>", "if then\nrest"),
    ("<p><math><semantics><mi>x</mi><annotation>\\x</annotation></semantics></math></p><p>rest</p>", "x\nrest"),
    ("<p>a</p><canvas>no canvas</canvas><object><p>held</p></object><p>rest</p>", "a\nheld\nrest"),
    ("<title-bar>a</title-bar><p>rest</p>", "a\nrest"),
])
def test_what_holds_markup_or_closes_itself(inner, want):
    assert text(f"<article>{inner}</article>") == want


@pytest.mark.parametrize("page", [
    '<body class="single-post no-sidebar"><article>%s</article></body>',
    '<body class="search social"><div class="content has-sidebar">%s</div></body>',
    '<main class="page-with-comments">%s</main>',
    '<html><body><form id="aspnetForm"><div class="content">%s</div></form></body></html>',
    '<form class="form"><article>%s</article></form>',
    '<div class="widget"><article>%s</article></div>',
    '<div id="header"><main class="x">%s</main></div>',
])
def test_outer_containers_do_not_discard_the_article(page):
    assert text(page % "<p>Text.</p>") == "Text."


@pytest.mark.parametrize("page", [
    '<div class="comments"><article>%s</article></div>', '<div class="related"><article>%s</article></div>',
    '<div class="sidebar">%s</div>', '<article><div class="sidebar no-print">%s</div></article>',
    '<div hidden><main>%s</main></div>', '<main><form>%s</form></main>',
    '<div class="comments"><div class="widget"><article>%s</article></div></div>',
])
def test_inner_boilerplate_stays_out(page):
    assert text(page % "<p>Text.</p>") == ""
