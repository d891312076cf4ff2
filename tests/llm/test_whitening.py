"""Whitening against exact arithmetic and matrices with known eigenvectors."""

from fractions import Fraction

import numpy as np
import pytest

from newsloom.llm import whitening

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, x string, whitened int"


def exact_covariance(rows):
    """n, sums and covariance of the distinct rows, in fractions."""
    fit = sorted({tuple(r) for r in rows})
    n, d = len(fit), len(fit[0])
    sums = [sum(r[i] for r in fit) for i in range(d)]
    centred = [[r[i] - Fraction(sums[i], n) for i in range(d)] for r in fit]
    return n, sums, [[sum(c[i] * c[j] for c in centred) / n for j in range(d)] for i in range(d)]


def grid(vector):
    return [int(np.floor(64 * float(c))) + 1_000_000 for c in vector]


def usable(vector):
    return vector is not None and all(c is not None and np.isfinite(c) for c in vector)


def checked(rows, vectors):
    """The rows against the exact covariance of the vectors."""
    kept = [(k, grid(v)) for k, v in vectors if usable(v)]
    n, sums, covariance = exact_covariance([x for _, x in kept])
    v = np.array([[float(c) for c in r] for r in covariance])
    values = np.linalg.eigvalsh(v)[::-1]
    count = max(r["component"] for r in rows)
    assert len(rows) == len(kept) * count and len({r["identity_error"] for r in rows}) == 1
    assert rows[0]["identity_error"] <= 1e-4
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    for k, x in kept:
        for component in range(1, count + 1):
            for r in got[k][component]:
                assert r["n"] == n
                assert abs(r["explained"] - values[component - 1] / values.sum()) <= 1e-9
        assert sum((n * a - s) ** 2 for a, s in zip(x, sums)) in {r["deviation"] for r in got[k][1]}
    return n, sums, v, got


def test_query_on_the_whole_table(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    rows = whitening.query(spark, FOLDER).collect()
    n, sums, v, got = checked(rows, vectors)
    values, axes = np.linalg.eigh(v)
    mean = np.array([float(Fraction(s, n)) for s in sums])
    for k, x in vectors:
        want = (np.array(grid(x)) - mean) @ axes[:, ::-1][:, :16] / np.sqrt(values[::-1][:16])
        have = np.array([got[k][c][0]["whitened"] for c in range(1, 17)])
        assert np.allclose(np.abs(have), np.abs(want), atol=1e-8)


ROWS = [
    (1, [0.5, 0.25, 3.0], "a", 1), (1, [0.5, 0.25, 3.0], "a", 1), (None, [0.1, 0.9, -2.0], None, None), (4, None, "n", 0),
    (5, [1.0, None, 2.0], "n", 0), (6, [float("nan"), 1.0, 1.0], "n", 0), (7, [float("inf"), 1.0, 1.0], "n", 0),
    (8, [], "short", 0), (9, [1.0, 2.0], "short", 0), (10, [-7.0, 0.3, 1.0], "b", 0), (11, [2.0, 1.3, 0.01], "b", 0),
    (12, [1e38, 1.0, 1.0], "huge", 0),
]


def test_edge_rows(spark):
    rows = whitening.whiten(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert {r["vec_id"] for r in rows} == {1, None, 10, 11}
    checked(rows, [(k, v) for k, v, *_ in ROWS if k in (1, None, 10, 11)])


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_nothing_varies(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect() == []


def test_large_numbers_stay_exact(spark):
    rows = [(k, [float(3.0**k), 2.0**50 * k, -1.0 * k * k]) for k in range(9)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    n, sums, _ = exact_covariance([grid(v) for _, v in rows])
    for r in found.filter("component = 1").collect():
        want = sum((n * a - s) ** 2 for a, s in zip(grid(rows[r["vec_id"]][1]), sums))
        assert r["deviation"] == (want if want < 2**63 else None)


def test_copies_count_once(spark):
    rows = [(k, [float(k % 7), float(k * k % 11), float(k % 3)]) for k in range(30)]
    many = rows + [(100 + i, rows[0][1]) for i in range(300)]
    schema = "vec_id bigint, embedding array<float>"
    def one(r):
        return whitening.whiten(spark.createDataFrame(r, schema)).filter("vec_id < 30").select("vec_id", "component", "n", "deviation")

    assert sorted(one(rows).collect()) == sorted(one(many).collect())


def rotated(values, seed=0):
    """A symmetric matrix of extended precision with given eigenvalues."""
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (3 * np.eye(d, dtype=np.longdouble) - q.T @ q) / 2
    return (q * np.array(values, np.longdouble)) @ q.T, q


@pytest.mark.parametrize("values", [
    [9.0, 5.0, 3.0, 1.0, 0.5], [4.0, 4.0 - 1e-9, 4.0 - 2e-9, 1.0, 1.0 - 1e-11, 1e-3], [2.0, 2.0, 2.0, 1.0, 1.0, 0.0],
    [1.0 + k * 1e-12 for k in range(12, 0, -1)], [float(2.0**-k) for k in range(24)], [0.0, 0.0],
])
def test_refinement(values):
    a, q = rotated(values)
    a = (a + a.T) / 2
    got, x = whitening.refined_eigen(a)
    scale = max(max(values), 1e-300)
    assert np.abs(got - np.array(values, np.longdouble)).max() <= 1e-17 * scale
    assert np.abs(x.T @ x - np.eye(len(values))).max() <= 1e-17
    assert np.abs(a @ x - x * got).max() <= 1e-17 * scale
    # a vector is known as well as its gap allows
    for i, v in enumerate(values):
        gap = min((abs(v - w) for j, w in enumerate(values) if j != i), default=1)
        if gap > 1e-13 * scale:
            assert 1 - abs(float(x[:, i] @ q[:, i])) <= 1e-16 + (1e-17 * scale / gap) ** 2


def test_float32_alone_would_not_do():
    a, q = rotated([4.0, 4.0 - 1e-9, 1.0, 0.5])
    rough = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    assert max(1 - abs(float(rough[:, i] @ q[:, i])) for i in range(2)) > 1e-6
