"""Personal data against the plain patterns, disclosure against plain counts."""

import hashlib
import math
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import private_terms as P

PLAIN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(d) for d in digits])):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def right(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == 1:
        return all(int(p) <= 255 for p in value.split("."))
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == 0 or 9 <= len(digits) <= 15


def plain(text):
    return [(k, *m.span()) for k, p in enumerate(PLAIN) for m in re.finditer(p, text) if right(k, m[0])]


SAMPLES = [
    "a@b.com.x@y.zz, a@b.com_c@d.ee @x.y a@b a@b. %+@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 00000000255.0.0.1 1.2.3. 1..2.3.4",
    "4111 1111-1111 1111 4111111111111112 0000000000000 1 2 3", "+1 (017) 555-7713. +12345678 +1 234 567 890 123 456 +1((((", "",
    "+4111111111111111 4111111111111111@mail.example.org 10.0.0.1@host.net", "é@x.com ü+1 22 333 4444 5٣",
]


@pytest.mark.parametrize("text", SAMPLES)
def test_samples(text):
    assert P.base_spans(text) == plain(text)


@settings(deadline=None, max_examples=500)
@given(st.text(alphabet="a1.@-+ 40(_", max_size=40))
def test_random_texts(text):
    assert P.base_spans(text) == plain(text)


@pytest.mark.parametrize("unit", ["a", "1", "1.", "+1 ", "a.", "@a", "1 ", "+(", "é ", "a@b.c "])
def test_time_in_proportion(unit):
    assert len(P.base_spans(unit * 200_000)) >= 0  # any quadratic pattern would not end


def names(spans):
    return ",".join(f"{(*P.KINDS, 'term')[k]}:{s}:{e}" for k, s, e in spans)


FILLER = "one two three four five six seven eight nine ten".split()


def people():
    """Zora always stands by her address, in other surroundings each time; Quill has a
    page of his own that is copied; Mara is named without her address as often."""
    texts = []
    for i in range(6):
        words = [f"w{i}{w}" for w in FILLER]
        texts.append(f"{' '.join(words[:4])} Zora zora@mail.example {' '.join(words[4:])}")
        texts.append(f"{' '.join(words[4:])} Mara mara@mail.example {' '.join(words[:3])}")
        texts += [f"Mara went {' '.join(words)} {k}" for k in range(30)]
        texts.append(f"{i} copied footer: Quill quill@mail.example and the same words for all of us in the end")
    texts += ["Here Zora writes alone", "the quick the lazy", None, "", "Zora", "Zora"] + [f"plain text number {i}" for i in range(400)]
    return texts


def brute(texts):
    """Spans by the definitions: counts over distinct texts."""
    distinct = sorted({t or "" for t in texts})
    near, places = defaultdict(set), defaultdict(set)
    of_entity, of_term = defaultdict(set), defaultdict(set)
    for t in distinct:
        spans = plain(t)
        words = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"\w{2,}", t)]
        for w in words:
            of_term[w[2]].add(t)
        words = [w for w in words if all(w[1] <= s or w[0] >= e for _, s, e in spans)]
        for k, s, e in spans:
            name = (k, t[s:e].lower() if k < 2 else re.sub("[^0-9]", "", t[s:e]))
            around = tuple([w[2] for w in words if w[1] <= s][-P.WINDOW:] + [w[2] for w in words if w[0] >= e][:P.WINDOW])
            of_entity[name].add(t)
            for w in around:
                near[name, w].add(t)
                places[name, w].add(around)
    n, share = len(distinct), defaultdict(float)
    for (e, w), where in near.items():
        if len(places[e, w]) >= P.SUPPORT and len(of_entity[e]) < n:
            value = math.log(n * len(where) / (len(of_term[w]) * len(of_entity[e]))) / math.log(n / len(of_entity[e]))
            share[w] = max(share[w], value)
    for t in texts:
        t = t or ""
        spans = plain(t)
        yield spans, [
            (P.TERM, m.start(), m.end()) for m in re.finditer(r"\w{2,}", t)
            if share[m[0].lower()] >= P.GENERALISE and all(m.end() <= s or m.start() >= e for _, s, e in spans)
        ]


@pytest.mark.parametrize("limit", [P.BROADCAST_BYTES, 0])
def test_terms_equal_plain_counts(spark, limit):
    texts = people()
    docs = spark.createDataFrame([(i // 2, t, 7) for i, t in enumerate(texts)], "doc_id bigint, text string, _terms int")
    got = P.digest(P.scan(docs, limit=limit)).collect()
    want = []
    for i, (base, terms) in enumerate(brute(texts)):
        counts = [sum(k == kind for k, *_ in base) for kind in range(4)]
        want.append((i // 2, *counts, hashlib.sha256(names(base).encode()).hexdigest(), names(base + terms)))
    assert sorted(tuple(r) for r in got) == sorted(want)
    found = {texts[i][s:e] for i, (_, terms) in enumerate(brute(texts)) for _, s, e in terms}
    assert found == {"Zora"}


def test_common_candidates_are_given_up_early(spark):
    """Tasks name at most one text more than the threshold allows, and what counts stays."""
    texts = people()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    terms = spark.createDataFrame([("mara", 5), ("zora", 5000), ("quill", 3)], "term string, most bigint")
    found = P.occurrences(docs.coalesce(1), terms)
    counts = {r["term"]: r["count"] for r in found.groupBy("term").count().collect()}
    assert counts == {"mara": 6, "zora": 8, "quill": 4}


def test_sanitised(spark):
    texts = people()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r["doc_id"]: r["text"] for r in P.sanitise(P.scan(docs)).collect()}
    assert rows[texts.index("Here Zora writes alone")] == "Here [name] writes alone"
    assert rows[texts.index(None)] is None and "[email]" in rows[0] and "zora" not in rows[0].lower()


def test_query_on_the_smallest_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = {r["doc_id"]: r for r in P.query(spark, folder).collect()}
    assert len(rows) == len(docs)
    for doc, (base, terms) in zip(docs, brute([r["text"] for r in docs])):
        got = rows[doc["doc_id"]]
        assert got["base_sha256"] == hashlib.sha256(names(base).encode()).hexdigest()
        assert got["spans"] == names(base + terms)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, spans string")
    assert P.digest(P.scan(docs)).collect() == []
