import math
import zlib
from collections import Counter

import numpy as np
import pytest

from newsloom.llm import lm


def held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w] + [None]


ROWS = [(i, f"The cat {i % 7} sat on the mat, thé {'x' * (i % 3)} and  THE dog{i % 11}\n" * (i % 5 + 1)) for i in range(200)]
EDGE = [(None, "the null"), (500, None), (501, ""), (502, " \n"), (503, "neverseen " * 3), (3, ROWS[3][1]), (504, "w " * 30000),
        (505, "a\x00b \x1c")]


def check_base(rows, got):
    train = Counter(w for d, t in rows if not held(d) for w in words(t))
    n, v = sum(train.values()), len(train)
    want = []
    for d, t in rows:
        ws = words(t)
        base = sum(math.log10((train[w] + 1) / (n + 1 * (v + 1))) for w in ws)
        want.append((str(d), held(d), len(ws), sum(train[w] > 0 for w in ws), n, round(base, 4)))
    have = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got]
    assert [x[:5] for x in sorted(have)] == [x[:5] for x in sorted(want)]
    assert np.allclose([x[5] for x in sorted(have)], [x[5] for x in sorted(want)], atol=1e-3)


def test_base_scores_and_counts(spark):
    rows = ROWS + EDGE
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, row string")
    got = lm.score_texts(df).collect()
    check_base(rows, got)
    assert all(r["score"] <= 0 for r in got)
    fair = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 200]
    assert sum(r["score"] for r in fair) > sum(r["base_score"] for r in fair)


@pytest.mark.parametrize("hot_words", [512, 0])
def test_score_is_the_mixture(spark, monkeypatch, hot_words):
    """Against the formula over plain counts of the same classes; the words that
    are looked up in the table change nothing."""
    monkeypatch.setattr(lm, "HOT", max(hot_words, 1))
    if not hot_words:
        monkeypatch.setattr(lm, "hot_words", lambda rows: np.array([0], np.uint64))
    rows = lm.numbered(spark.createDataFrame(ROWS, "doc_id long, text string"))
    model = lm.learn(rows)
    got = {r["doc"]: r["score"] for r in lm.log_scores(rows, model).collect()}
    tokens = {d: lm._tokens([t.encode()])[:2] for d, t in ROWS}
    one, two, context = Counter(), Counter(), Counter()
    for d, (w, g) in tokens.items():
        if not held(d):
            one.update(w.tolist())
            two.update(zip(w.tolist(), g.tolist()))
            context.update(g.tolist())
    total = sum(one.values())
    assert total == model.counts.total and len(one) == model.vocabulary
    for d, (w, g) in tokens.items():
        score = 0.0
        for a, b in zip(w.tolist(), g.tolist()):
            mix = model.mix[b]
            p = mix[0] * two[a, b] / max(context[b], 1) + mix[1] * one[a] / total + mix[2] / (len(one) + 1)
            score += math.log10(p)
        assert math.isclose(score, got[d], rel_tol=1e-9)


def test_model_is_a_distribution(spark):
    """Over the known words and one unknown the estimates add up to one."""
    rows = lm.numbered(spark.createDataFrame(ROWS, "doc_id long, text string"))
    model = lm.learn(rows)
    table = model.counts.by_class
    for g in np.flatnonzero(model.counts.contexts)[:50]:
        mix = model.mix[g]
        assert math.isclose(mix.sum(), 1) and table[:, g].sum() == model.counts.contexts[g]


def test_weights_come_from_deleted_counts():
    """Pairs seen once predict nothing when deleted: their order gets no weight."""
    seen_once = {(3, None, -8): 100}
    assert lm.learn_weights(seen_once, 10)[3][0] < 1e-4
    repeated = {(3, -1, -40): 100}
    assert lm.learn_weights(repeated, 10)[3][0] > 0.9


def test_nothing_to_learn_from(spark):
    some = [d for d in range(100) if held(d)][:3]
    df = spark.createDataFrame([(d, "a b") for d in some], "doc_id long, text string")
    got = lm.score_texts(df).collect()
    assert len(got) == 3 and {(r["base_score"], r["score"], r["train_tokens"]) for r in got} == {(0.0, 0.0, 0)}
    assert lm.score_texts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = lm.query(spark, sf).collect()
    check_base(rows, got)
