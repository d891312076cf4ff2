"""Whitening of embeddings by eigenvectors that are refined in higher precision.

Entries are read on a grid, x = floor(64 c) + 1000000, and equal x-vectors count
once. Their covariance is exact: a first pass adds up the distinct vectors, a
second the products of what is centred at the whole number next to each mean, and
the small rest of the mean is taken out in whole-number arithmetic on the driver.
Tasks send one matrix each, which are added up in levels, so the driver receives a
fixed number of them whatever the table's size.

The eigenvectors are those of the covariance in float32, refined by the iteration
of Ogita and Aishima: from R = I - X'X and S = X'AX follow better eigenvalues and a
correction X + XE by matrix products alone, here in extended precision. Pairs whose
eigenvalues are too close for that correction are only made orthogonal by it. They
form clusters, and each cluster is solved apart: the covariance, shifted by the
cluster's mean and projected on its vectors, is a small problem whose own scale
brings the near eigenvalues apart; its solution turns the vectors of the cluster.

The matrix products of d x d in extended precision run on the driver, which suits
a d of some hundreds. Vectors are shuffled once, to find the distinct ones.

Defined cases: vectors that are null, or hold a null, a number that isn't finite, or
one of 2^55 or more (whose x would leave the range), are left out, as are vectors of
another length than most have (of equally frequent lengths the longest counts).
Repeated rows and ids are rows of their own. Components whose eigenvalue is nothing
but rounding next to the largest are left out, so a table of one distinct vector, or
none, gives no rows. A deviation beyond the range of long is null. Further columns
of ``transform`` stay, but for those of the names of its results.
"""

import json
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import materialize

GRID, SHIFT = 64, 1_000_000
LARGEST = float(1 << 61)  # of 64 c
COMPONENTS = 16
REDUCERS = 8  # matrices that reach the driver
EXACT = 1 << 53  # sums of whole numbers in doubles are exact below
ROWS = 4096  # multiplied at a time
ROUNDS = 40


def on_grid(vectors: DataFrame, vector="embedding", name="x") -> DataFrame:
    """The rows with a usable vector, and its place on the grid as ``name``."""
    entry = F.col(vector)
    usable = vectors.filter(F.forall(entry, lambda c: F.abs(c.cast("double") * GRID) < LARGEST))
    sizes = usable.groupBy(F.size(entry).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).first()
    d = sizes["d"] if sizes else 0
    return usable.filter(F.size(entry) == d).withColumn(
        name, F.transform(entry, lambda c: F.floor(c.cast("double") * GRID).cast("bigint") + SHIFT)
    )


def _added_up(df: DataFrame, of_batches):
    """The sum over all tasks of the list of numbers that ``of_batches`` makes of a
    task's matrices; None without rows."""

    def sums(batches):
        total = of_batches(list_whole(b.column(0)) for b in batches if b.num_rows)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"total": [json.dumps(total)]})

    def add(a, b):
        return [x + y for x, y in zip(a, b)]

    def merged(batches):
        parts = (json.loads(t) for batch in batches for t in batch.column(0).to_pylist())
        total = None
        for part in parts:
            total = part if total is None else add(total, part)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"total": [json.dumps(total)]})

    partial = df.mapInArrow(sums, "total string").repartition(REDUCERS).mapInArrow(merged, "total string")
    rows = [json.loads(r["total"]) for r in partial.collect()]  # at most REDUCERS
    return reduce(add, rows) if rows else None


def list_whole(column) -> np.ndarray:
    """Arrow list column of equal lengths to a matrix of whole numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(matrices):
    """The number of rows and the sum of each column."""
    n, total = 0, None
    for x in matrices:
        n += len(x)
        # sums of the upper and lower halves of the bits stay in range
        part = [(int(high) << 31) + int(low) for high, low in zip((x >> 31).sum(axis=0), (x & 0x7FFFFFFF).sum(axis=0))]
        total = part if total is None else [a + b for a, b in zip(total, part)]
    return None if total is None else [n, *total]


def _whole_products(y):
    """Y'Y in exact whole numbers."""
    most = int(np.abs(y).max(initial=0))
    step = min(ROWS, EXACT // max(1, most * most))
    if not step:
        wide = y.astype(object)
        return wide.T @ wide
    total = None
    for at in range(0, len(y), step):
        part = y[at:at + step].astype(np.float64)
        part = (part.T @ part).astype(np.int64).astype(object)
        total = part if total is None else total + part
    return total


def _products(centre):
    def of_batches(matrices):
        total = None
        for x in matrices:
            part = _whole_products(x - centre)
            total = part if total is None else total + part
        return None if total is None else [int(v) for v in total[np.triu_indices(len(centre))]]

    return of_batches


def refined_eigen(matrix):
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix of
    extended precision, from a float32 decomposition."""
    kind = np.longdouble
    d = len(matrix)
    scale = np.abs(matrix).max(initial=0) or kind(1)
    a = matrix / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(kind)
    one, norm, least = np.eye(d, dtype=kind), np.linalg.norm(a.astype(np.float64)), 8 * d * np.finfo(kind).eps
    for _ in range(ROUNDS):
        r = one - x.T @ x
        r = (r + r.T) / 2
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, r, s, values = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], values[order]
        off = np.sqrt(((s - np.diag(values)) ** 2).sum())
        loss = np.sqrt((r**2).sum())
        if off <= least * max(norm, least) and loss <= least:
            break
        bound = 2 * (off + norm * loss)
        gaps = values[None, :] - values[:, None]
        close = np.abs(gaps) <= bound
        # (S + l_j R) / (l_j - l_i) as R / 2 and a part that is exactly antisymmetric,
        # so that rounding next to small gaps costs no orthogonality
        middle = (values[None, :] + values[:, None]) / 2
        x = x + x @ (r / 2 + np.where(close, 0, s + middle * r) / np.where(close, 1, gaps))
        for start, end in _clusters(values, bound):
            x[:, start:end] = x[:, start:end] @ _turn(a, x[:, start:end], values[start:end].mean())
    for _ in range(2):  # turns within clusters may have cost the last bits of orthogonality
        x = x @ (3 * one - x.T @ x) / 2
    return values * scale, x / np.sqrt((x * x).sum(axis=0))


def _clusters(values, bound):
    """Runs of falling values whose neighbours are within the bound, if longer than one."""
    breaks = [0, *(np.flatnonzero(values[:-1] - values[1:] > bound) + 1).tolist(), len(values)]
    return [(i, j) for i, j in zip(breaks, breaks[1:]) if j - i > 1]


def _turn(a, x, centre):
    """The rotation that makes the vectors of one cluster eigenvectors of the
    matrix shifted by the cluster's centre."""
    small = x.T @ (a @ x - centre * x)
    small = (small + small.T) / 2
    scale, one = np.abs(small).max(), np.eye(x.shape[1], dtype=x.dtype)
    if not scale:
        return one
    turn = np.linalg.eigh((small / scale).astype(np.float64))[1][:, ::-1].astype(x.dtype)
    return turn @ (3 * one - turn.T @ turn) / 2  # orthogonal to the last bits


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: rows of the fit list, their exact sums, the covariance's
    eigenvalues and unit eigenvectors in columns, and its trace."""

    n: int
    sums: list
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def centre(self):
        """The whole numbers next to the means, and the exact rest of each."""
        near = [round(Fraction(s, self.n)) for s in self.sums]
        return near, [s - self.n * c for s, c in zip(self.sums, near)]


def fit(distinct: DataFrame, components=COMPONENTS) -> Whitening | None:
    """Fit on a table of distinct grid vectors (column x); None if nothing varies."""
    found = _added_up(distinct.select("x"), _sums)
    if found is None or len(found) < 2:
        return None
    n, *sums = found
    d = len(sums)
    centre, rest = Whitening(n, sums, None, None, 0).centre
    products = _added_up(distinct.select("x"), _products(np.array(centre, np.int64)))
    exact = np.zeros((d, d), object)
    exact[np.triu_indices(d)] = products
    # n^2 times the covariance, in whole numbers
    exact = n * (exact + np.triu(exact, 1).T) - np.outer(np.array(rest, object), np.array(rest, object))
    values, vectors = refined_eigen(exact.astype(np.longdouble) / (np.longdouble(n) * n))
    kept = int((values[:components] > d * np.finfo(np.float64).eps * values[0]).sum()) if values[0] > 0 else 0
    if not kept:
        return None
    trace = float(sum(int(exact[i, i]) for i in range(d)) / Fraction(n * n))
    return Whitening(n, sums, values[:kept].astype(np.float64), vectors[:, :kept].astype(np.float64), trace)


def _projector(model: Whitening):
    centre, rest = model.centre
    near, rest = np.array(centre, np.int64), np.array([float(Fraction(r, model.n)) for r in rest])
    axes = model.vectors / np.sqrt(model.values)

    def project(x):
        return ((x - near).astype(np.float64) - rest) @ axes

    return project


def _deviations(x, model: Whitening):
    """Sums over the dimensions of (n x - S)^2, exact."""
    centre, rest = model.centre
    y = x - np.array(centre, np.int64)
    most = model.n * int(np.abs(y).max(initial=0)) + max(map(abs, rest))
    if most * most * x.shape[1] < 1 << 63:
        z = model.n * y - np.array(rest, np.int64)
        return pa.array((z * z).sum(axis=1), pa.int64())
    wide = (model.n * y.astype(object) - np.array(rest, object)) ** 2
    return pa.array([v if v < 1 << 63 else None for v in wide.sum(axis=1)], pa.int64())


def transform(gridded: DataFrame, model: Whitening, x="x", name="whitened") -> DataFrame:
    """``gridded`` with (deviation, values) of its grid vectors as ``name``."""
    project = _projector(model)

    @F.arrow_udf("struct<deviation:bigint,values:array<double>>")
    def run(column: pa.Array) -> pa.Array:
        matrix = list_whole(column) if len(column) else np.zeros((0, len(model.sums)), np.int64)
        values = project(matrix)
        offsets = pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))
        return pa.StructArray.from_arrays([_deviations(matrix, model), lists], names=["deviation", "values"])

    return gridded.withColumn(name, run(x))


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the
    identity, from its values themselves."""
    project, k = _projector(model), len(model.values)

    def of_batches(matrices):
        total = None
        for x in matrices:
            w = project(x)
            part = np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
            total = part if total is None else total + part
        return None if total is None else total.tolist()

    total = np.array(_added_up(distinct.select("x"), of_batches)) / model.n
    mean, products = total[:k], total[k:].reshape(k, k)
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max())


RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whiten(vectors: DataFrame, key="vec_id", vector="embedding", components=COMPONENTS) -> DataFrame:
    """One row for each usable vector and component, see RESULT."""
    spark = vectors.sparkSession
    gridded = on_grid(vectors.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).alias("embedding")))
    distinct = materialize(gridded.select("x").distinct(), "whitening-fit")
    model = fit(distinct, components)
    if model is None:
        return spark.createDataFrame([], RESULT)
    error = identity_error(distinct, model)
    shares = F.array(*[F.lit(float(v)) for v in model.values / model.trace])
    rows = transform(gridded.select("vec_id", "x"), model)
    return rows.select("vec_id", "whitened.deviation", F.posexplode("whitened.values").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def query(spark, sf_dir) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
