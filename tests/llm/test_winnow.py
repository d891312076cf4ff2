import hashlib
import random
import re

import numpy as np
import pytest

from newsloom.llm import winnow as W

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(docs, items, window=10):
    wanted = {}
    for item, text in items:
        ws = words(text)
        n = min(len(ws), window)
        for i in range(len(ws) - n + 1 if n else 0):
            wanted.setdefault(tuple(ws[i:i + n]), set()).add(item)
    lengths = {len(w) for w in wanted}
    out = []
    for doc, text in docs:
        ws, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(ws) - n + 1):
                if tuple(ws[i:i + n]) in wanted:
                    hit.update(range(i, i + n))
                    found |= wanted[tuple(ws[i:i + n])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(ws), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id long, text string, hash string")
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, length int")
    rows = W.digest(*W.scan(d, b)).collect()
    return sorted((tuple(r) for r in rows), key=str)


def sample(seed, n_docs=60, n_items=12, vocabulary=6):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "B", "cé", "d1", "É", "日本"][:vocabulary])
    text = lambda n: "".join(word() + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i % 9, text(rng.choice([0, 1, 2, 3, 5, 9, 10, 11, 20]))) for i in range(n_items)]
    docs = [(i, text(rng.randint(0, 40)) + (items[i % n_items][1] if i % 3 == 0 else "") + text(5)) for i in range(n_docs)]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    docs, items = sample(seed)
    docs += [(None, None), (1, ""), (1, "..."), (1, items[0][1]), docs[0], docs[0]]
    items += [(None, docs[1][1] or "x"), (3, None), (4, ""), items[0]]
    assert run(spark, docs, items) == brute(docs, items)


def test_only_long_items(spark):
    rng = random.Random(9)
    text = lambda n: " ".join(f"w{rng.randint(0, 400)}" for _ in range(n))
    items = [(i, text(40)) for i in range(30)]
    docs = [(i, text(100) + " " + " ".join(items[i % 30][1].split()[i % 20:i % 20 + 8 + i % 5]) + " " + text(60)) for i in range(120)]
    got = run(spark, docs, items)
    assert got == brute(docs, items) and {r[5] for r in got} == {True, False}


def test_empty_sides(spark):
    assert run(spark, [(1, "a b c")], []) == brute([(1, "a b c")], [])
    assert run(spark, [], [(1, "a b c")]) == []


def test_long_text_in_segments(monkeypatch):
    data = " ".join(f"Wort{i % 911}é" for i in range(5000)).encode()
    want = W.byte_class_hashes(data, W.IS_WORD)
    monkeypatch.setattr(W, "SEGMENT_BYTES", 64)
    got = W.byte_class_hashes(data, W.IS_WORD)
    assert all((a == b).all() for a, b in zip(want, got)) and len(set(want[0].tolist())) == 911


def test_every_shared_window_shares_a_fingerprint():
    rng = np.random.default_rng(3)
    for length in range(1, 13):
        hashes = rng.integers(0, 4, 300).astype(np.uint64)
        pos, _ = W.fingerprints(hashes, np.zeros(300, int), length)
        k = (length + 1) // 2
        for s in range(300 - length + 1):
            own, _ = W.fingerprints(hashes[s:s + length], np.zeros(length, int), length)
            assert len(own) == 1 and s + own[0] in pos and own[0] + k <= length


def test_drop_contaminated_keeps_the_rest(spark):
    docs = [(1, "x " * 12 + "one two three four"), (2, "a b c d e f g h i j k"), (2, "fine"), (None, None)]
    d = spark.createDataFrame([(*x, 5) for x in docs], "doc_id long, text string, n_words int")
    b = spark.createDataFrame([(7, "A b, c d e f g h i j")], "item_id long, text string")
    left = W.drop_contaminated(d, b)
    assert left.columns == d.columns
    assert sorted(map(tuple, left.collect()), key=str) == sorted([(*docs[0], 5), (*docs[2], 5), (*docs[3], 5)], key=str)
