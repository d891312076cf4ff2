import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from newsloom.llm import bm25

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, queries, top):
    """rows: (id, text). All scores, the best by rounded score, id, position."""
    docs = [Counter(words(t)) for _, t in rows]
    sizes = [sum(d.values()) for d in docs]
    mean = sum(sizes) / len(sizes)
    df = Counter(w for d in docs for w in d)
    idf = {w: math.log(1 + (len(rows) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    out = {}
    for q in queries:
        found = []
        for i, d in enumerate(docs):
            s = sum(idf[w] * d[w] * 2.2 / (d[w] + 1.2 * (0.25 + 0.75 * sizes[i] / mean)) for w in docs[q] if w in d)
            if s > 0:
                found.append((-round(s, 6), rows[i][0] is None, rows[i][0] or 0, i))
        out[q] = [(i, -s) for s, _, _, i in sorted(found)[:top]]
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(400)] + ["É", "日本"]
    weights = [1 / (i + 1) for i in range(len(pool))]
    texts = [" ".join(rng.choices(pool, weights, k=rng.randint(0, 60))) for _ in range(n)]
    return texts + texts[:20] + [None, "", "...", "W1 w1, W1"]


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert abs(a[1] - b[1]) < 2e-6, (got, want)


def test_equals_brute_force(spark):
    rows = [(i * 3 % 1009, t) for i, t in enumerate(corpus(1, 700))] + [(None, "w5 w6"), (3, "w5 w6 w7")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, terms int").coalesce(1)
    index = bm25.build_index(df)
    found = bm25.search(index, index.filter("doc % 5 = 0")).collect()
    order = [r["row"] for r in index.orderBy("row").collect()]
    queries = [i for i, (d, t) in enumerate(rows) if d is not None and d % 5 == 0 and words(t)]
    want = brute(rows, queries, 10)
    got = {}
    for r in sorted(found, key=lambda r: (r["query_row"], r["rank"])):
        got.setdefault(order.index(r["query_row"]), []).append((order.index(r["row"]), r["score"]))
    assert set(got) == set(want)
    for q in want:
        same(got[q], want[q])
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] or len({round(s, 5) for _, s in got[q]}) < len(got[q])


def test_blocks_of_queries_and_shards_change_nothing(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(corpus(2, 300))), "doc_id long, text string")
    index = bm25.build_index(df.repartition(5))
    asked = index.filter("doc % 7 = 0")
    want = bm25.search(index, asked).orderBy("query_row", "rank").collect()
    monkeypatch.setattr(bm25, "QUERY_TERMS", 200)
    got = bm25.search(index, asked).orderBy("query_row", "rank").collect()
    assert [(r["query_id"], r["rank"], r["doc"], r["score"]) for r in got] == [(r["query_id"], r["rank"], r["doc"], r["score"]) for r in want]


def test_pruning_skips_blocks_and_loses_nothing(monkeypatch):
    rng = np.random.default_rng(5)
    n = 4000
    terms = [np.unique(rng.zipf(1.3, 40).clip(max=3000)) for _ in range(n)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n)), pa.array(np.arange(n)), pa.array([len(t) for t in terms]),
         pa.array([t.tolist() for t in terms], pa.list_(pa.int64())), pa.array([[1] * len(t) for t in terms], pa.list_(pa.int32()))],
        names=["row", "doc", "length", "terms", "counts"],
    )
    every = np.unique(np.concatenate(terms))
    df = np.bincount(np.searchsorted(every, np.concatenate(terms)))
    queries = bm25.Queries([], [], [], every, np.log(1 + (n - df + 0.5) / (df + 0.5)), 20.0)
    shard = bm25.Shard([batch], queries)
    opened, held = [], 0
    plain = bm25.Shard._open

    def counted(self, segments, chosen, scores):
        own = segments[chosen[self.block[segments]]]
        opened.append(int((self.start[own + 1] - self.start[own]).sum()))
        return plain(self, segments, chosen, scores)

    monkeypatch.setattr(bm25.Shard, "_open", counted)
    for q in range(0, n, 97):
        own = np.searchsorted(every, terms[q])
        whole = np.zeros(n)
        at = bm25._ranges(shard.start[shard.of_term[own]], shard.start[shard.of_term[own + 1]])
        np.add.at(whole, shard.doc[at], shard.impact[at])
        best = np.lexsort((shard.rows, -np.round(whole, 6)))[:10]
        before = len(opened)
        assert shard.search(own, 10)[0].tolist() == best.tolist()
        del opened[before:]
        found, scores = shard.search(own, 10, whole[best[-1]])
        assert found.tolist() == best.tolist() and np.allclose(scores, whole[best], atol=1e-6)
        held += len(at)
    assert sum(opened) < 0.9 * held


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    index = bm25.build_index(df)
    assert bm25.search(index, index).collect() == []
    blank = bm25.build_index(spark.createDataFrame([(0, None), (50, " ")], "doc_id long, text string"))
    assert bm25.search(blank, blank).collect() == []


def test_common_terms_are_not_stepped_through(monkeypatch):
    """With a threshold, neither postings nor blocks of common terms are listed one by one; exact all the same."""
    rng = np.random.default_rng(6)
    n = 3000
    terms = [np.unique(rng.zipf(1.2, 60).clip(max=5000)) for _ in range(n)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n)), pa.array(np.arange(n)), pa.array([len(t) for t in terms]),
         pa.array([t.tolist() for t in terms], pa.list_(pa.int64())), pa.array([[1] * len(t) for t in terms], pa.list_(pa.int32()))],
        names=["row", "doc", "length", "terms", "counts"],
    )
    every = np.unique(np.concatenate(terms))
    df = np.bincount(np.searchsorted(every, np.concatenate(terms)))
    queries = bm25.Queries([], [], [], every, np.log(1 + (n - df + 0.5) / (df + 0.5)), 20.0)
    shard = bm25.Shard([batch], queries)
    plain, listed, held = bm25._ranges, [], 0
    for q in range(0, n, 61):
        own = np.searchsorted(every, terms[q])
        whole = np.zeros(n)
        at = plain(shard.start[shard.of_term[own]], shard.start[shard.of_term[own + 1]])
        np.add.at(whole, shard.doc[at], shard.impact[at])
        best = np.lexsort((shard.rows, -np.round(whole, 6)))[:10]
        with monkeypatch.context() as m:
            m.setattr(bm25, "_ranges", lambda a, b: listed.append(int((b - a).sum())) or plain(a, b))
            found, scores = shard.search(own, 10, whole[best[-1]])
        assert found.tolist() == best.tolist() and np.allclose(scores, whole[best], atol=1e-6)
        held += len(at)
    assert sum(listed) < 0.25 * held


def two_languages(seed, n):
    """Documents of two languages, with copies, null ids, wordless and very long texts, as a batch; their terms."""
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 120, n)
    sizes[:3] = 4000
    terms = [np.unique((rng.zipf(1.15, k) % 40_000) * 2 + i % 2 + rng.integers(0, 2, k) * (rng.random(k) < 0.05)) for i, k in enumerate(sizes)]
    terms[10:40] = [terms[10]] * 30
    terms[50:53] = [np.empty(0, np.int64)] * 3
    hashes = np.sort(rng.integers(-(2**63), 2**63, 80_002))
    terms = [hashes[t] for t in terms]
    counts = [rng.integers(1, 4, len(t)) for t in terms]
    counts[10:40] = [counts[10]] * 30
    ids = [None if i % 17 == 0 else i * 7 % n for i in range(n)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n)), pa.array(ids, pa.int64()), pa.array([int(c.sum()) for c in counts], pa.int64()),
         pa.array([t.tolist() for t in terms], pa.list_(pa.int64())), pa.array([c.tolist() for c in counts], pa.list_(pa.int32()))],
        names=["row", "doc", "length", "terms", "counts"],
    )
    return batch, terms, counts, ids


class Shared:
    def __init__(self, value):
        self.value = value


def test_groups_of_queries_are_exact_and_step_through_few_postings(monkeypatch):
    """Many queries at once: the scores of each, with and without thresholds, but not each query's postings one by one."""
    n, top = 3000, 10
    batch, terms, counts, ids = two_languages(7, n)
    asked = [i for i in range(0, n, 6) if len(terms[i])] + list(range(10, 40)) + [1, 2]
    every = np.unique(np.concatenate([terms[i] for i in asked]))
    place = [np.searchsorted(every, t).clip(max=len(every) - 1) for t in terms]
    matrix = np.zeros((n, len(every)))
    lengths = np.array([c.sum() for c in counts])
    mean = lengths.mean()
    for i, (p, t, c) in enumerate(zip(place, terms, counts)):
        held = every[p] == t
        matrix[i, p[held]] = c[held]
    df = (matrix > 0).sum(axis=0)
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    impact = idf * matrix * 2.2 / (matrix + 1.2 * (0.25 + 0.75 * lengths / mean)[:, None])
    want = {}
    for k, i in enumerate(asked):
        scores = np.round(impact[:, place[i]].sum(axis=1), 6)
        found = np.flatnonzero(impact[:, place[i]].any(axis=1)).tolist()
        want[k] = [(j, scores[j]) for j in sorted(found, key=lambda j: (-scores[j], ids[j] is None, ids[j] or 0, j))[:top]]
    queries = bm25.Queries(list(range(len(asked))), [ids[i] for i in asked], [terms[i] for i in asked], every, idf, mean)
    listed, plain = [], bm25._ranges
    monkeypatch.setattr(bm25, "_ranges", lambda a, b: listed.append(int((b - a).sum())) or plain(a, b))
    held = sum(int(df[place[i]].sum()) for i in asked)
    for parts in ([batch], [batch.slice(0, 1100), batch.slice(1100)]):
        listed.clear()
        got = {}
        for part in bm25._task_search(Shared(queries), top)(iter(parts)):
            for r in part.to_pylist():
                assert r["query_id"] == ids[asked[r["query_row"]]] and r["doc"] == ids[r["row"]]
                got.setdefault(r["query_row"], []).append((r["row"], r["score"]))
        for k in want:
            best = sorted(got[k], key=lambda x: (-x[1], ids[x[0]] is None, ids[x[0]] or 0, x[0]))
            assert [j for j, _ in best[:top]] == [j for j, _ in want[k]]
            assert np.allclose([s for _, s in best[:top]], [s for _, s in want[k]], atol=2e-6)
        assert sum(listed) < 0.3 * held
        queries.least = {k: v[-1][1] for k, v in want.items() if len(v) == top}


def test_places_of_terms():
    terms = np.sort(np.array([-(2**63), -5, -1, 0, 1, 7, 2**63 - 1] + list(range(1000, 1400))))
    asked = np.array([-(2**63), -(2**63) + 1, -6, -5, 0, 2, 7, 999, 1000, 1399, 1400, 2**63 - 1])
    place, there = bm25.Places(terms).of(asked)
    assert there.tolist() == np.isin(asked, terms).tolist() and (terms[place[there]] == asked[there]).all()
    assert bm25.Places(np.array([3])).of(np.array([-4, 3, 9]))[1].tolist() == [False, True, False]
