"""Document quality by a regularised quadratic discriminant.

Every text is reduced to a short vector of transformed statistics (shares as
logits, counts as logarithms). Each class has a mean and a covariance, which is
shrunk towards the pooled one and then towards its own diagonal. A document's
score is the logistic of the difference of the two log densities, computed from
the inverted Cholesky factors, and of the class priors.

Moments are sums that tasks make and Spark adds up; only they come to the driver
(two classes of D + D * D numbers). All labelled rows are learned from.

Defined cases: a null text is the empty string, which is scored like any other;
rows with a null or other label than 0 and 1 teach nothing; a document with
several label rows counts once for each; a null id is held in for learning but
meets no label; if a class has no examples every score is the smoothed share of
the label 1; an empty table gives no rows. Repeated rows are all returned.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import materialize

SHRINK_POOLED, SHRINK_DIAGONAL = 0.7, 0.02
RIDGE = 1e-4  # added to each variance
KEEP_AT = 0.7
FOLDS, HELD_OUT = 4, 2

_code = np.arange(256)
_LOWER = (_code >= 97) & (_code <= 122)
_UPPER = (_code >= 65) & (_code <= 90)
_DIGIT = (_code >= 48) & (_code <= 57)
_SPACE = (_code == 32) | ((_code >= 9) & (_code <= 13))
_COMMON = np.isin(_code, [ord(c) for c in ".,;:'-?\"()"])
_BANG, _BAR, _LINE = ord("!"), ord("|"), ord("\n")
_SYMBOL = (_code > 32) & (_code < 127) & ~(_LOWER | _UPPER | _DIGIT | _COMMON)
CLASSES = np.stack([_LOWER, _UPPER, _DIGIT, _COMMON, _SYMBOL, _code >= 128]).astype(np.float64)


def _logit(part, whole):
    """The log odds of a share, with half an item on either side."""
    return float(np.log((part + 0.5) / (whole - part + 0.5)))


def statistics(data: bytes):
    """Transformed statistics of UTF-8 bytes, linear in their length."""
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    visible = float(len(data) - counts[_SPACE].sum())
    lower, upper, digit, common, symbol, other = (CLASSES @ counts).tolist()
    words = data.split()
    n = len(words)
    seen = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    most = max(seen.values(), default=0)
    same = sum(map(bytes.__eq__, words, words[1:]))
    lengths = np.fromiter(map(len, words), np.float64, n) if n else np.zeros(1)
    lines = [x for x in data.split(b"\n") if x.strip()]
    shouted = sum(w.isupper() and len(w) > 1 for w in words)
    marked = sum(not (w[-1:].isalnum() or w[-1] >= 128 or w[-1:] in b".,") for w in words)
    return [
        float(np.log1p(n)),
        _logit(upper, visible), _logit(digit, visible), _logit(common, visible),
        _logit(symbol, visible), _logit(float(counts[_BANG]), visible), _logit(float(counts[_BAR]), visible),
        _logit(other, visible),
        _logit(len(seen), n), _logit(most, n), _logit(same, n),
        float(np.log1p(lengths.mean())), float(np.log1p(lengths.std())), float(np.log1p(lengths.max())),
        _logit(len(set(lines)), len(lines)), float(np.log((n + 1) / (len(lines) + 1))),
        _logit(shouted, n), _logit(marked, n),
    ]


N_STATISTICS = len(statistics(b""))


def text_statistics(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([statistics((t.as_py() or "").encode()) for t in texts], pa.list_(pa.float64()))

    return run(text)


def _matrix(lists: pa.Array):
    return lists.flatten().to_numpy().reshape(-1, N_STATISTICS)


def _moments(batches):
    """One row per class that a task has seen: its count, sum and sum of products."""
    total = {}
    for batch in batches:
        classes = batch.column("quality").to_numpy()
        x = _matrix(batch.column("statistics"))
        for k in np.unique(classes).tolist():
            own = x[classes == k]
            n, s, p = total.get(k, (0, 0.0, 0.0))
            total[k] = n + len(own), s + own.sum(axis=0), p + own.T @ own
    if total:
        rows = [np.concatenate([[n], s, p.ravel()]) for n, s, p in total.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))],
            names=["quality", "moments"],
        )


@dataclass
class Discriminant:
    """Means, inverted Cholesky factors and offsets of the two classes."""

    means: list
    factors: list
    offsets: list
    constant: float | None = None  # the score where a class is unknown

    def log_odds(self, x):
        densities = [
            offset - 0.5 * (((x - mean) @ factor.T) ** 2).sum(axis=1)
            for mean, factor, offset in zip(self.means, self.factors, self.offsets)
        ]
        return densities[1] - densities[0]

    def scores(self, x):
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -60, 60)))


def fit(moments: dict) -> Discriminant:
    """``moments`` by class: count, sums, sums of products, in one array."""
    d = N_STATISTICS
    n = [float(moments[k][0]) if k in moments else 0.0 for k in (0, 1)]
    if min(n) < 1:
        return Discriminant([], [], [], (n[1] + 1) / (sum(n) + 2))
    means, own = [], []
    for k in (0, 1):
        mean = moments[k][1:d + 1] / n[k]
        means.append(mean)
        own.append(moments[k][d + 1:].reshape(d, d) / n[k] - np.outer(mean, mean))
    pooled = (n[0] * own[0] + n[1] * own[1]) / sum(n)
    factors, offsets = [], []
    for k in (0, 1):
        cov = (1 - SHRINK_POOLED) * own[k] + SHRINK_POOLED * pooled
        cov = (1 - SHRINK_DIAGONAL) * cov + SHRINK_DIAGONAL * np.diag(np.diag(cov)) + RIDGE * np.eye(d)
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        offsets.append(float(np.log(n[k] / sum(n)) - np.log(np.diag(lower)).sum()))
    return Discriminant(means, factors, offsets)


def learn(described: DataFrame, labels: DataFrame, doc="doc_id") -> Discriminant:
    """Fit on all labelled rows of a table with ``statistics``."""
    known = labels.filter(F.col("quality").isin(0, 1)).select(
        F.col(doc).alias("_id"), F.col("quality").cast("int").alias("quality")
    )
    rows = described.join(known, described[doc] == F.col("_id")).select("quality", "statistics")
    parts = rows.mapInArrow(_moments, "quality int, moments array<double>")
    sums = (
        parts.select("quality", F.posexplode("moments").alias("i", "x"))
        .groupBy("quality", "i").agg(F.sum("x").alias("x")).collect()
    )
    size = 1 + N_STATISTICS + N_STATISTICS ** 2
    moments = {k: np.zeros(size) for k in {r["quality"] for r in sums}}
    for r in sums:
        moments[r["quality"]][r["i"]] = r["x"]
    return fit(moments)


def score(statistics_column: Column, model: Discriminant) -> Column:
    @F.arrow_udf("double")
    def run(lists: pa.Array) -> pa.Array:
        return pa.array(model.scores(_matrix(lists)))

    return F.round(run(statistics_column), 9)


def held_out(doc="doc_id", folds=FOLDS, fold=HELD_OUT) -> Column:
    return F.crc32(F.coalesce(F.col(doc).cast("string"), F.lit(""))) % folds == fold


def describe(docs: DataFrame, doc="doc_id", text="text") -> DataFrame:
    """(id, held_out, statistics), stored, as it is read for learning and scoring."""
    return materialize(
        docs.select(doc, held_out(doc).alias("held_out"), text_statistics(F.col(text)).alias("statistics")),
        "text-statistics",
    )


def assess(docs: DataFrame, labels: DataFrame, doc="doc_id", text="text") -> DataFrame:
    """(id, held_out, score, predicted) of every row. Held-out documents teach
    nothing."""
    described = describe(docs, doc, text)
    model = learn(described.filter(~F.col("held_out")), labels, doc)
    scored = described.withColumn("score", score(F.col("statistics"), model))
    return scored.select(doc, "held_out", "score", (F.col("score") >= KEEP_AT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, doc="doc_id", text="text") -> DataFrame:
    """The rows predicted good, as they are. Texts stay in their rows: the
    statistics are taken once to learn and once to filter."""
    model = learn(describe(docs, doc, text).filter(~F.col("held_out")), labels, doc)
    return docs.filter(score(text_statistics(F.col(text)), model) >= KEEP_AT)


def query(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return assess(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
