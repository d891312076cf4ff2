"""The word contexts of op9 against the formula over plain counts."""

import math
from collections import Counter

import pytest

from newsloom.llm import lm, word_lm
from tests.llm.test_lm import EDGE, ROWS, held, words


@pytest.mark.parametrize("n_chunks, parts", [(1, 1), (13, 50)])
def test_score_is_the_mixture_over_the_word_before(spark, monkeypatch, n_chunks, parts):
    """Contexts are words, not classes of them; chunks and parts change nothing."""
    monkeypatch.setattr(word_lm, "LEAST_PARTS", parts)
    odd = spark.createDataFrame(ROWS + EDGE, "doc_id long, text string").repartition(n_chunks)
    rows = lm.numbered(odd)
    chunks = word_lm.chunks_of(rows)
    assert chunks.count() == n_chunks
    replies = word_lm.replies_to(chunks)
    model = word_lm.learn(chunks, replies)
    one, two, context = Counter(), Counter(), Counter()
    for d, t in ROWS + EDGE:
        if not held(d):
            ws = words(t)
            one.update(ws)
            two.update(zip(["<s>"] + ws, ws))
            context.update(["<s>"] + ws[:-1])
    total = sum(one.values())
    assert (model.total, model.vocabulary) == (total, len(one))
    want = []
    for d, t in ROWS + EDGE:
        ws, score = words(t), 0.0
        for h, w in zip(["<s>"] + ws, ws):
            mix = model.mix[int(math.log2(context[h]))] if context[h] else model.unseen
            score += math.log10(mix[0] * two[h, w] / max(context[h], 1) + mix[1] * one[w] / total + mix[2] / (len(one) + 1))
        want.append((str(d), len(ws), round(score, 4)))
    got = [(str(r["doc"]), r["n_tokens"], round(r["score"], 4)) for r in word_lm.log_scores(chunks, replies, model).collect()]
    assert [x[:2] for x in sorted(got)] == [x[:2] for x in sorted(want)]
    assert all(math.isclose(a[2], b[2], rel_tol=1e-6, abs_tol=1e-3) for a, b in zip(sorted(got), sorted(want)))


def test_contexts_outnumber_any_table_of_classes(spark):
    """3,000 words, each always followed by its own: a model of words knows what follows,
    also in texts it has not learned from; classes mix the words."""
    texts = [(i, " ".join(f"left{j} right{j}" for j in range(i % 30, 3000, 30))) for i in range(600)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = [r for r in lm.score_texts(df).collect() if r["held_out"]]
    # half of the words follow for sure: they add next to nothing to a text's score
    per_word = [r["score"] / r["n_tokens"] for r in got]
    assert got and min(per_word) > -0.1
    rows = lm.numbered(df)
    classes = {r["doc"]: r["score"] / r["n_tokens"] for r in lm.log_scores(rows, lm.learn(rows)).collect()}
    assert all(classes[r["doc_id"]] < -0.3 for r in got)
