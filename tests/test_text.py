"""Text functions against their plain Python definitions."""

from collections import Counter
from html import unescape

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions.html import decode_entities, html_to_text
from tests.parsed import parse_text

SPACES = ["\t", "\n", "\x0b", "\x1c", "\x1f", "\x85", " ", " ", "　", " "]
QUICK = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def results(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def py_chunks(text):
    return [c.strip() for c in text.split(".") if len(c.strip()) > 20]


def py_stats(text, threshold):
    chunks = py_chunks(text)
    if not chunks:
        return (0, 0, 1.0, 0, 0)
    counts = Counter(chunks)
    return (
        len(chunks), len(counts), len(counts) / len(chunks), max(counts.values()),
        sum(1 for n in counts.values() if n >= threshold),
    )


def py_cut(text, markers=("Patreon", "patreon.com")):
    low = text.lower()
    points = [low.find(m.lower()) for m in markers if m.lower() in low]
    return text[: min(points)].rstrip() if points else text


def test_strip_drops_every_unicode_space(spark):
    values = [s + "a" + s + "b" + s for s in SPACES] + ["", "".join(SPACES)]
    assert results(column(spark, values), X.strip(F.col("t"))) == [v.strip() for v in values]


@QUICK
@given(st.lists(st.text(alphabet=SPACES + list("ab.")), min_size=1, max_size=60))
def test_strip_equals_python(spark, values):
    assert results(column(spark, values), X.strip(F.col("t"))) == [v.strip() for v in values]


def test_blank_is_null_or_whitespace(spark):
    assert results(column(spark, [None, "", "  \n", "x"]), X.is_blank(F.col("t"))) == [True, True, True, False]


EDGE_TEXTS = [
    "no full stop but this is long enough",
    "a" * 20 + "." + "b" * 21,
    ("this sentence comes back again. " * 9) + ("and this one ten whole times over. " * 10) + ("one more here, eleven times in all. " * 11),
    "\x1cfirst chunk with odd spaces .\x0bfirst chunk with odd spaces.",
    "", ".....",
]


def test_chunk_stats_at_the_edges(spark):
    got = results(column(spark, EDGE_TEXTS), X.chunk_stats(F.col("t")))
    assert [tuple(g) for g in got] == [py_stats(t, 10) for t in EDGE_TEXTS]


def test_chunk_stats_of_null(spark):
    assert tuple(results(column(spark, [None]), X.chunk_stats(F.col("t")))[0]) == (0, 0, 1.0, 0, 0)


SENTENCE = st.sampled_from(["the same long sentence again", "another quite long sentence", "short", "a third sentence, long too "])


@QUICK
@given(st.lists(st.lists(SENTENCE, max_size=30).map(".".join), min_size=1, max_size=30))
def test_chunk_stats_equal_counter(spark, values):
    got = results(column(spark, values), X.chunk_stats(F.col("t"), 3))
    assert [tuple(g) for g in got] == [py_stats(v, 3) for v in values]


@QUICK
@given(st.lists(st.lists(SENTENCE, max_size=30).map(".".join), min_size=1, max_size=30))
def test_most_repeated_equals_most_common(spark, values):
    got = results(column(spark, values), X.most_repeated(F.col("t"), 2))
    want = [[(n, c) for c, n in Counter(py_chunks(v)).most_common(2)] for v in values]
    assert [[(g["repeats"], g["chunk"]) for g in row] for row in got] == want


CUTS = [
    "no marker, the trailing space stays ", "text patreon more", "text PATREON x Patreon y",
    "Patreon first", "mid  Support us at patreon.com now", "", "a  Patreon",
]


def test_boilerplate_cut(spark):
    assert results(column(spark, CUTS), X.boilerplate_cut(F.col("t"))) == [py_cut(t) for t in CUTS]


def test_boilerplate_cut_with_other_markers(spark):
    assert results(column(spark, ["keep THIS cut that"]), X.boilerplate_cut(F.col("t"), ["this"])) == ["keep"]


def test_preview_counts_characters(spark):
    assert results(column(spark, ["é" * 150]), X.preview(F.col("t"), 100)) == ["é" * 100]


HTML = {
    "<p>one</p><p>two <b>three</b></p>": "one two three",
    "<p>a<template>hidden <b>x</b></template>b</p>": "a b",
    '<script>var t="</p>";</script>q<!-- c > d -->r<style>p{}</style>': "q r",
    "a &amp; b &lt;i&gt; &quot;c&quot; &copy; &middot; &#39;d&#39; &#xe9;&nbsp;": "a & b <i> \"c\" © · 'd' é",
    "&amp;lt; stays": "&lt; stays",
    "<a title='x > y' href=z>k</a> < 5 & 6": "k < 5 & 6",
    "<p>open <b>bold": "open bold",
    "": "",
    "<ruby>漢<rp>(</rp><rt>kan</rt></ruby>": "漢",
    "&#0;&#xD800;&#99999999999;": "�" * 3,
    "<br/> <br/>x\ny": "x\ny",
}


def test_html_to_text(spark):
    assert results(column(spark, list(HTML)), html_to_text(F.col("t"))) == list(HTML.values())


def test_html_to_text_of_null(spark):
    assert results(column(spark, [None]), html_to_text(F.col("t"))) == [""]


def test_patterns_and_parser_agree_on_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for row in pages.select("html", html_to_text("html").alias("a")).collect():
        assert row["a"] == parse_text(row["html"])


REFERENCES = [
    "it&#146;s", "&#150; &#x96; &#128;&#159;", "&#0000000000000000000065;&#x000000000000041;", "?a=1&order=2", "&notit;",
    "AT&ampT", "&notin; &notin x", "&copy2024 &copy;", "&amp;amp; &ampamp;", "&unknown; &;", "& &&lt", "&#; &#x; &#xg;",
    "&#1114111; &#1114112;", "&#55296;&#xDFFF;", "&Aacute&aacute;", "&frac12x &frac1", "&nbsp;a", "&#99999999999999999999999;",
    "&lt&gt", "&ltx", "&quot;&QUOT&Quot;", "a&b;c", "&thetasym;&thorn", "&yen", "&#65", "&#x41g",
]


def test_references_follow_the_standard(spark):
    got = results(column(spark, REFERENCES), decode_entities(F.col("t")))
    assert got == [unescape(t) if "1114111" not in t else "\U0010ffff \ufffd" for t in REFERENCES]


PIECES = st.sampled_from(["&", "#", "x", "12", "0", "9", "amp", "not", "in", "lt", ";", " ", "copy", "é", "order", "AT", "150", "Aacute"])


@QUICK
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=1, max_size=40))
def test_references_equal_the_library(spark, values):
    # what the library leaves out as invalid, control characters and the like, stays in the standard
    def valid(text):
        return "".join(c for c in text if ord(c) >= 32 and not 127 <= ord(c) < 160 and not 0xFDD0 <= ord(c) < 0xFDF0)

    got = results(column(spark, values), decode_entities(F.col("t")))
    assert [valid(t) for t in got] == [valid(unescape(t)) for t in values]


TAGS = st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<br>", "text", " two words ", "&amp;", "<i class='x'>", "é"])


@QUICK
@given(st.lists(st.lists(TAGS, max_size=20).map("".join), min_size=1, max_size=30))
def test_patterns_equal_parser(spark, values):
    assert results(column(spark, values), html_to_text(F.col("t"))) == [parse_text(v) for v in values]
