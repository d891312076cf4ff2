"""The search comparison: three methods over growing nested scales."""

import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.graph import build_graph, entry_points, graph_search
from newsloom.operators.ivf import (
    build_ivf, choose_nlist, choose_nprobe, ivf_search, sample_centroids, train_centroids,
)
from newsloom.operators.recall import recall_at_k
from newsloom.operators.sampling import first_rows, query_sample
from newsloom.operators.search import exact_topk
from newsloom.schemas import METHOD_LABELS, N_QUERIES, RESULT_SCHEMA, SCALES, SEED, TOP_K
from newsloom.session import materialize


def _timed(make):
    start = time.perf_counter()
    result = make()
    return result, time.perf_counter() - start


def _subset(vectors, scale, total, seed):
    """The vectors of a scale, stored once: every step reads them, and none the whole table for a few."""
    return vectors if scale == total else materialize(first_rows(vectors, scale, seed=seed), "subset")


def compare_searches(vectors, scales=SCALES, n_queries=N_QUERIES, k=TOP_K, seed=SEED) -> DataFrame:
    """RESULT rows (scale, method, build_time_s, avg_query_ms, recall_at_10)."""
    spark = vectors.sparkSession
    vectors = vectors.select("vec_id", "embedding")
    total = vectors.count()
    sizes = sorted({min(s, total) if s is not None else total for s in scales})
    queries = materialize(query_sample(vectors, sizes, n_queries, seed=seed), "queries")
    asked = max(1, queries.count())
    rows = []

    def record(scale, method, build, seconds, recall):
        rows.append((scale, method, build, seconds / asked * 1000, recall))

    def recall_of(found):
        return recall_at_k(found, truth, k).first()["recall"]

    for scale in sizes:
        subset = _subset(vectors, scale, total, seed)
        truth, seconds = _timed(lambda: materialize(exact_topk(subset, queries, k), "truth"))
        record(scale, "brute_force", 0.0, seconds, 1.0)

        nlist = choose_nlist(scale)

        index, build = _timed(lambda: build_ivf(subset, train_centroids(subset, nlist, seed)))
        found, seconds = _timed(
            lambda: materialize(ivf_search(index, queries, k, choose_nprobe(nlist)), "found")
        )
        record(scale, "ivf", build, seconds, recall_of(found))

        def graph():
            starts = materialize(sample_centroids(subset, nlist, seed), "centres")
            return starts, *build_graph(subset, starts)

        (starts, nodes, members), build = _timed(graph)
        found, seconds = _timed(
            lambda: materialize(
                graph_search(nodes, entry_points(starts, nodes, queries), queries, k, members=members), "found"
            )
        )
        record(scale, "graph", build, seconds, recall_of(found))
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def recall_by_scale(vectors, scales=SCALES, n_queries=N_QUERIES, k=TOP_K, seed=SEED) -> DataFrame:
    """(scale, method, n_queries, recall) of exact and cluster-pruned search with
    sampled centres: the part of the comparison that any engine can repeat."""
    vectors = vectors.select("vec_id", "embedding")
    total = vectors.count()
    sizes = sorted({min(s, total) if s is not None else total for s in scales})
    queries = materialize(
        query_sample(vectors, sizes, n_queries, seed=seed).select("qid", "embedding"), "queries"
    )
    results = []
    for scale in sizes:
        subset = _subset(vectors, scale, total, seed)
        nlist = choose_nlist(scale)
        centres = materialize(sample_centroids(subset, nlist, seed), "centres")
        truth = materialize(exact_topk(subset, queries, k), "truth")
        found = ivf_search(build_ivf(subset, centres), queries, k, choose_nprobe(nlist))
        for method, predicted in (("brute_force", truth), ("ivf", found)):
            results.append(
                recall_at_k(predicted, truth, k).select(
                    F.lit(scale).cast("bigint").alias("scale"), F.lit(method).alias("method"),
                    "n_queries", "recall",
                )
            )
    union = results[0]
    for result in results[1:]:
        union = union.unionByName(result)
    return union


def method_recall(vectors, n_queries=N_QUERIES, k=TOP_K, probes=5, seed=SEED) -> DataFrame:
    """(method, n_queries, recall) of the three methods over all vectors with sampled
    centres; each against the exact result."""
    vectors = vectors.select("vec_id", "embedding")
    total = vectors.count()
    queries = materialize(query_sample(vectors, [total], n_queries, seed=seed).select("qid", "embedding"), "queries")
    nlist = choose_nlist(total)
    centres = materialize(sample_centroids(vectors, nlist, seed), "centres")
    truth = materialize(exact_topk(vectors, queries, k), "truth")
    nodes, members = build_graph(vectors, centres, nprobe=probes)
    found = {
        "brute_force": truth,
        "ivf": ivf_search(build_ivf(vectors, centres), queries, k, choose_nprobe(nlist)),
        "graph": graph_search(nodes, entry_points(centres, nodes, queries), queries, k, members=members),
    }
    rows = [recall_at_k(f, truth, k).select(F.lit(m).alias("method"), "n_queries", "recall") for m, f in found.items()]
    return reduce(DataFrame.unionByName, rows)


def labelled(results: DataFrame, methods=None) -> DataFrame:
    """Rows of the methods that have a ``label``, with it."""
    methods = METHOD_LABELS if methods is None else methods
    labels = F.create_map(*[F.lit(x) for pair in methods.items() for x in pair])
    known = results.filter(F.col("method").isin(list(methods)))
    return known.withColumn("label", F.element_at(labels, F.col("method")))


def chart_series(results: DataFrame, methods=None) -> DataFrame:
    """Chart-ready rows: label, scale, latency and its logarithm, recall."""
    return (
        labelled(results, methods)
        .select(
            "method", "label", "scale",
            "build_time_s", "avg_query_ms", F.log10("avg_query_ms").alias("log10_query_ms"), "recall_at_10",
        )
        .orderBy("method", "scale")
    )
