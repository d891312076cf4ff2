import random

import pytest
import xxhash

from newsloom.llm import components, simhash


def brute_print(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    if not ws:
        return 0
    shingles = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Least id of each component, for (id, print) rows."""
    values = sorted({p for _, p in prints})
    parent = {v: v for v in values}

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                parent[top(b)] = top(a)
    least = {}
    for d, p in prints:
        if d is not None:
            least[top(p)] = min(least.get(top(p), d), d)
    return sorted(((d, f"{p:016x}", least.get(top(p))) for d, p in prints), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Ab", "cé", "d.", "E", "ff", "g\x1c", "日本"]) + str(rng.randint(0, 30))
    base = [[word() for _ in range(rng.randint(1, 120))] for _ in range(25)]
    texts = []
    for i in range(150):
        ws = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            ws[rng.randrange(len(ws))] = word()
        texts.append(rng.choice([" ", "\n", " \t"]).join(ws))
    return texts + [None, "", " \n", "one", "one two", "ONE TWO", "one two three", "x " * 5000]


@pytest.mark.parametrize("hot", [simhash.HOT, 2])
def test_equals_brute_force(spark, hot):
    texts = corpus(1)
    rows = [(i * 7 % 1000, t, "clash") for i, t in enumerate(texts)] + [(None, "one", "c"), (7, texts[1], "c"), (3, "zz", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((tuple(r) for r in simhash.near_duplicates(df, hot=hot).collect()), key=str)
    assert got == brute_components([(d, brute_print(t)) for d, t, *_ in rows])


def test_chains_and_dense_groups(spark):
    rng = random.Random(4)
    start = rng.getrandbits(64)
    chain = [start]
    for _ in range(40):  # each links to the next, few to others
        v = chain[-1]
        for b in rng.sample(range(64), 3):
            v ^= 1 << b
        chain.append(v)
    center = rng.getrandbits(64)
    dense = [center ^ (1 << a) ^ (1 << b) for a in range(0, 64, 2) for b in range(1, 20, 3) if a != b]
    lone = [rng.getrandbits(64) for _ in range(300)]
    prints = [(i, p) for i, p in enumerate(chain + dense + lone)]
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints]
    want = {p: c for _, p, c in brute_components(prints)}
    for hot in (simhash.HOT, 3):
        found = simhash.components(spark.createDataFrame(signed, "doc_id long, fp long"), hot=hot).collect()
        assert {f"{r['fp'] % (1 << 64):016x}": r["component"] for r in found} == want


def test_tree_follows_only_useful_edges():
    rng = random.Random(2)
    values = list({rng.getrandbits(10) for _ in range(400)})
    tree = simhash.Tree(1)
    links = [(v, o) for v in values for o in tree.add(v)]
    assert all((a ^ b).bit_count() <= 1 for a, b in links)
    groups = {r: set() for r in range(len(values))}
    for i in range(len(values)):
        groups[tree._top(i)].add(values[i])
    assert len(links) == len(values) - sum(bool(g) for g in groups.values())


def test_roots(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (5, 5), (30, 3)] + [(100, i) for i in range(101, 200)]
    found = {tuple(r) for r in components.roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {(i, 1) for i in (1, 2, 3, 30)} | {(i, 7) for i in (7, 8, 9)} | {(i, 100) for i in range(100, 200)}
    assert components.roots(spark.createDataFrame([], "a long, b long")).collect() == []


def test_keep_one(spark):
    texts = corpus(2)
    rows = [(i, t, "x", 5) for i, t in enumerate(texts)]
    rows += [(0, texts[0], "x", 5), (None, texts[0], "x", 5), (None, "lonely text", "x", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, row int")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert {(r["fp"], r["row"]) for r in kept.collect()} == {("x", 5)}
    got = sorted(str(r["doc_id"]) for r in kept.collect())
    groups = {(str(c) if c is not None else p) for _, p, c in brute_components([(d, brute_print(t)) for d, t, *_ in rows])}
    assert len(got) == len(groups) and "None" in got


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == [] and simhash.keep_one(df).collect() == []


def test_query(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = sorted((tuple(r) for r in simhash.query(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute_components([(r["doc_id"], brute_print(r["text"])) for r in table])
