"""Queries over vectors: sampling, exact, cluster-pruned and graph search."""

from pyspark.sql import functions as F

from newsloom.functions import vectors as vec
from newsloom.operators import benchmark, graph, ivf, recall, sampling, search
from newsloom.plans.tables import CENTRES, NEAR, NLIST, POSITIONED, UNIT, sql_queries, table, with_
from newsloom.schemas import EF_SEARCH, GRAPH_M, METHOD_LABELS, N_QUERIES, TOP_K
from newsloom.session import materialize

# Nested scales for the generated vectors; the last is the whole table.
SCALES = [100, 250, None]
GRAPH_PROBES = 5
SWEEP_QUERIES = 50


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "embedding")


def positioned(spark, sf):
    return sampling.shuffle_positions(vectors(spark, sf).select("vec_id"))


def asked(spark, sf, scales=(None,)):
    """The query table; it is small and read several times."""
    sample = sampling.query_sample(vectors(spark, sf), scales, N_QUERIES)
    return materialize(sample.select("qid", "embedding"), "queries")


def centres(spark, sf):
    """Sampled centres, which SQL can pick as well."""
    v = vectors(spark, sf)
    return materialize(ivf.sample_centroids(v, ivf.choose_nlist(v.count())), "centres")


def _shown(neighbours):
    return neighbours.withColumn("sim", F.round("sim", 6))


def l2_normalize(spark, sf):
    unit = vectors(spark, sf).select("vec_id", vec.l2_normalize(F.col("embedding")).alias("u"))
    return unit.select("vec_id", F.posexplode("u").alias("pos", "value")).withColumn("value", F.round("value", 6))


def nested_sample(spark, sf):
    """Every scale's members with their place in the shared shuffle."""
    p = positioned(spark, sf).select("vec_id", "pos")
    member = [F.when(F.lit(s is None) | (F.col("pos") <= F.lit(s or 0)), F.lit(str(s or "all"))) for s in SCALES]
    return p.select("vec_id", "pos", F.explode(F.filter(F.array(*member), lambda s: s.isNotNull())).alias("scale"))


def query_sample(spark, sf):
    """Queries with their place in the shuffle. All are in the smallest scale, so
    only that many keys are numbered."""
    smallest = min(s for s in SCALES if s)
    prefix = materialize(sampling.first_rows(vectors(spark, sf).select("vec_id"), smallest), "prefix")
    placed = sampling.shuffle_positions(prefix)
    return sampling.query_sample(placed, [None], SWEEP_QUERIES).select("qid", "pos")


def exact_topk(spark, sf):
    return _shown(search.exact_topk(vectors(spark, sf), asked(spark, sf), TOP_K))


def ivf_assign(spark, sf):
    return ivf.assign_cells(vectors(spark, sf), centres(spark, sf)).select("vec_id", "cell")


def ivf_probe(spark, sf):
    index = ivf.build_ivf(vectors(spark, sf), centres(spark, sf))
    return _shown(ivf.ivf_search(index, asked(spark, sf), TOP_K))


def ivf_search(spark, sf):
    """Trained centres instead of sampled ones."""
    v = vectors(spark, sf)
    c = ivf.train_centroids(v, ivf.choose_nlist(v.count()))
    return _shown(ivf.ivf_search(ivf.build_ivf(v, c), asked(spark, sf), TOP_K))


def ivf_search_all(spark, sf):
    """Trained centres with every cell probed, which must give the exact answer."""
    v = vectors(spark, sf)
    nlist = ivf.choose_nlist(v.count())
    index = ivf.build_ivf(v, ivf.train_centroids(v, nlist))
    return _shown(ivf.ivf_search(index, asked(spark, sf), TOP_K, nprobe=nlist))


def recall_at_k(spark, sf):
    """Mean recall of the index with sampled centres."""
    q = asked(spark, sf)
    index = ivf.build_ivf(vectors(spark, sf), centres(spark, sf))
    truth = search.exact_topk(vectors(spark, sf), q, TOP_K)
    found = ivf.ivf_search(index, q, TOP_K)
    return recall.recall_at_k(found, truth, TOP_K).withColumn("recall", F.round("recall", 6))


def edges(spark, sf):
    nodes, _ = graph.split_copies(vectors(spark, sf))
    near = materialize(ivf.nearest_cells(nodes, centres(spark, sf), GRAPH_PROBES), "near-cells")
    return graph.adjacency(graph.knn_edges(near, GRAPH_M), GRAPH_M)


def knn_graph(spark, sf):
    return edges(spark, sf).withColumn("sim", F.round("sim", 6))


def _graph(spark, sf):
    c = centres(spark, sf)
    return c, *graph.build_graph(vectors(spark, sf), c, GRAPH_M, GRAPH_PROBES)


def graph_expand(spark, sf):
    """One hop of the search from each query's own node."""
    _, nodes, _ = _graph(spark, sf)
    own = nodes.select("vec_id", "part").join(asked(spark, sf).select("qid"), F.col("vec_id") == F.col("qid"))
    start = materialize(own.select("qid", "vec_id", "part"), "start")
    return graph.expand(start, nodes, start).select("qid", "vec_id")


def graph_search(spark, sf):
    q = asked(spark, sf)
    c, nodes, members = _graph(spark, sf)
    found = graph.graph_search(nodes, graph.entry_points(c, nodes, q), q, TOP_K, members=members)
    return _shown(found)


def recall_by_scale(spark, sf):
    found = benchmark.recall_by_scale(vectors(spark, sf), SCALES, SWEEP_QUERIES)
    return found.withColumn("recall", F.round("recall", 6))


def recall_series(spark, sf):
    """Recall by method label and scale, as the chart shows it."""
    return benchmark.labelled(recall_by_scale(spark, sf)).select("label", "scale", "recall")


def method_recall(spark, sf):
    """Recall of all three methods over the whole table."""
    found = benchmark.method_recall(vectors(spark, sf), N_QUERIES, TOP_K, GRAPH_PROBES)
    return found.withColumn("recall", F.round("recall", 6))


def comparison_chart(spark, sf):
    """The comparison with what must hold of its times: a time for each build but that
    of the exact search, a time a query, and its logarithm."""
    rows = benchmark.chart_series(benchmark.compare_searches(vectors(spark, sf), SCALES))
    return rows.select(
        "label", "scale", (F.col("build_time_s") > 0).alias("built"), (F.col("avg_query_ms") > 0).alias("timed"),
        (F.abs(F.pow(F.lit(10.0), "log10_query_ms") - F.col("avg_query_ms")) < 1e-6 * F.col("avg_query_ms")).alias("on_log_axis"),
        ((F.col("recall_at_10") >= F.lit(0.0)) & (F.col("recall_at_10") <= 1)).alias("has_recall"),
    )


def search_comparison(spark, sf):
    """The whole comparison with measured times (which differ between runs)."""
    return benchmark.chart_series(benchmark.compare_searches(vectors(spark, sf), SCALES))


QUERIES = {
    f.__name__: f
    for f in [
        l2_normalize, nested_sample, query_sample, exact_topk, ivf_assign, ivf_probe, ivf_search, ivf_search_all,
        recall_at_k, knn_graph, graph_expand, graph_search, recall_by_scale, recall_series, method_recall,
        comparison_chart, search_comparison,
    ]
}

_QUERIES = sql_queries(N_QUERIES)
_EXACT = f"""exact AS (
  SELECT * FROM (
    SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY s DESC, vec_id) AS rank, vec_id, s AS sim
    FROM (SELECT qid, v.vec_id, round(list_inner_product(q.u, v.u), 9) AS s
          FROM queries JOIN unit q ON q.vec_id = qid, unit v) a) b
  WHERE rank <= {TOP_K})"""
_PROBE = f"""placed AS (SELECT vec_id, cell FROM near WHERE r = 1),
probes AS (
  SELECT qid, cell FROM queries JOIN near ON near.vec_id = qid
  WHERE r <= (SELECT greatest(1, CAST(floor(n * 0.1) AS BIGINT)) FROM nlist)),
probed AS (
  SELECT * FROM (
    SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY s DESC, vec_id) AS rank, vec_id, s AS sim
    FROM (SELECT qid, v.vec_id, round(list_inner_product(q.u, v.u), 9) AS s
          FROM probes JOIN placed USING (cell) JOIN unit v USING (vec_id) JOIN unit q ON q.vec_id = qid) a) b
  WHERE rank <= {TOP_K})"""
_EDGES = f"""node_near AS (SELECT near.* FROM near SEMI JOIN nodes USING (vec_id)),
forward AS (
  SELECT src, dst, s FROM (
    SELECT a.vec_id AS src, b.vec_id AS dst, round(list_inner_product(x.u, y.u), 9) AS s,
           row_number() OVER (PARTITION BY a.vec_id
             ORDER BY round(list_inner_product(x.u, y.u), 9) DESC, b.vec_id) AS rank
    FROM node_near a JOIN node_near b ON a.cell = b.cell AND b.r = 1 AND a.r <= {GRAPH_PROBES}
         AND a.vec_id <> b.vec_id
         JOIN unit x ON x.vec_id = a.vec_id JOIN unit y ON y.vec_id = b.vec_id) f
  WHERE rank <= {GRAPH_M}),
edges AS (
  SELECT src, dst, s FROM (
    SELECT src, dst, s, row_number() OVER (PARTITION BY src ORDER BY s DESC, dst) AS rank
    FROM (SELECT src, dst, max(s) AS s FROM (
            SELECT src, dst, s FROM forward UNION ALL SELECT dst, src, s FROM forward) u
          GROUP BY src, dst) g) h
  WHERE rank <= {2 * GRAPH_M})"""
_INDEX = with_(UNIT, POSITIONED, _QUERIES, NLIST, CENTRES, NEAR, _PROBE, _EXACT)
_GRAPH = with_(UNIT, POSITIONED, _QUERIES, NLIST, CENTRES, NEAR, _EDGES)

HOPS = 12  # of the SQL walk; on the given tables it ends earlier


def _hop(h):
    """One hop of the walk: the best rows so far, what the newest of them reach."""
    return f"""beam_{h} AS MATERIALIZED (SELECT * FROM scored_{h - 1}
  QUALIFY row_number() OVER (PARTITION BY qid ORDER BY s DESC, vec_id) <= {EF_SEARCH}),
fresh_{h} AS MATERIALIZED (SELECT DISTINCT qid, dst AS vec_id FROM beam_{h} JOIN edges ON src = vec_id WHERE hop = {h - 1}
  EXCEPT SELECT qid, vec_id FROM scored_{h - 1}),
scored_{h} AS MATERIALIZED (SELECT * FROM scored_{h - 1} UNION ALL
  SELECT qid, f.vec_id, round(list_inner_product(q.u, v.u), 9) AS s, {h} AS hop
  FROM fresh_{h} f JOIN unit q ON q.vec_id = qid JOIN unit v ON v.vec_id = f.vec_id)"""


_WALK = ",\n".join([f"""scored_0 AS MATERIALIZED (
  SELECT qid, cell AS vec_id, round(list_inner_product(q.u, c.u), 9) AS s, 0 AS hop
  FROM queries JOIN unit q ON q.vec_id = qid, centres c
  QUALIFY row_number() OVER (PARTITION BY qid ORDER BY round(list_inner_product(q.u, c.u), 9) DESC, cell) <= 4)"""]
    + [_hop(h) for h in range(1, HOPS + 1)]
    + [f"""last AS (SELECT * FROM scored_{HOPS}
  QUALIFY row_number() OVER (PARTITION BY qid ORDER BY s DESC, vec_id) <= {EF_SEARCH}),
copies AS (SELECT e.vec_id, min(f.vec_id) AS node FROM embeddings e JOIN embeddings f ON e.embedding = f.embedding GROUP BY e.vec_id)"""])

_SMALLEST = min(s for s in SCALES if s)


def sql_scale(scale):
    """One scale of the comparison, with names that end in the scale."""
    n = scale or "all"
    where = f"WHERE pos <= {scale}" if scale else ""
    ctes = f"""sub_{n} AS (SELECT u.vec_id, u.u, e.embedding FROM unit u
  JOIN (SELECT vec_id FROM positioned {where}) p USING (vec_id) JOIN embeddings e USING (vec_id)),
size_{n} AS (SELECT greatest(1, least(CAST(floor(4 * sqrt(count(*))) AS BIGINT), greatest(1, count(*) // 40))) AS n FROM sub_{n}),
centre_{n} AS (SELECT cell, u FROM (
  SELECT vec_id AS cell, row_number() OVER (ORDER BY md5('42:cell:' || vec_id), vec_id) AS r
  FROM (SELECT min(vec_id) AS vec_id FROM sub_{n} GROUP BY embedding) a) b
  JOIN sub_{n} ON vec_id = cell WHERE r <= (SELECT n FROM size_{n})),
near_{n} AS (SELECT vec_id, cell, row_number() OVER (
  PARTITION BY vec_id ORDER BY round(list_inner_product(v.u, c.u), 9) DESC, cell) AS r FROM sub_{n} v, centre_{n} c),
sims_{n} AS (SELECT qid, v.vec_id, round(list_inner_product(q.u, v.u), 9) AS s
  FROM queries JOIN unit q ON q.vec_id = qid, sub_{n} v),
true_{n} AS (SELECT qid, vec_id FROM sims_{n}
  QUALIFY row_number() OVER (PARTITION BY qid ORDER BY s DESC, vec_id) <= {TOP_K}),
found_{n} AS (SELECT s.qid, s.vec_id FROM sims_{n} s
  JOIN near_{n} v ON v.vec_id = s.vec_id AND v.r = 1
  JOIN near_{n} p ON p.vec_id = s.qid AND p.cell = v.cell
    AND p.r <= (SELECT greatest(1, CAST(floor(n * 0.1) AS BIGINT)) FROM size_{n})
  QUALIFY row_number() OVER (PARTITION BY s.qid ORDER BY s DESC, s.vec_id) <= {TOP_K})"""
    total = f"(SELECT count(*) FROM sub_{n}) AS scale"
    select = f"""SELECT {total}, 'brute_force' AS method, count(DISTINCT qid) AS n_queries, 1.0::DOUBLE AS recall FROM true_{n}
UNION ALL SELECT {total}, 'ivf' AS method, count(DISTINCT t.qid) AS n_queries,
  round(count(f.vec_id) / (count(DISTINCT t.qid) * {TOP_K}), 6) AS recall
FROM true_{n} t LEFT JOIN found_{n} f ON f.qid = t.qid AND f.vec_id = t.vec_id"""
    return ctes, select


_BY_SCALE = [sql_scale(s) for s in SCALES]

ORACLES = {
    "l2_normalize": with_(UNIT) + """SELECT vec_id, unnest(range(len(u))) AS pos,
  unnest(list_transform(u, lambda x: round(x, 6))) AS value FROM unit""",
    "nested_sample": with_(POSITIONED) + "SELECT vec_id, pos, scale FROM (" + " UNION ALL ".join(
        f"SELECT vec_id, pos, '{s or 'all'}' AS scale FROM positioned" + (f" WHERE pos <= {s}" if s else "")
        for s in SCALES
    ) + ") a",
    "query_sample": with_(POSITIONED, sql_queries(SWEEP_QUERIES, _SMALLEST))
    + "SELECT qid, pos FROM queries JOIN positioned ON vec_id = qid",
    "exact_topk": with_(UNIT, POSITIONED, _QUERIES, _EXACT)
    + "SELECT qid, rank, vec_id, round(sim, 6) AS sim FROM exact",
    "ivf_assign": with_(UNIT, NLIST, CENTRES, NEAR) + "SELECT vec_id, cell FROM near WHERE r = 1",
    "ivf_probe": _INDEX + "SELECT qid, rank, vec_id, round(sim, 6) AS sim FROM probed",
    "recall_at_k": _INDEX + f"""SELECT count(*) AS n_queries, round(avg(hits / {TOP_K}), 6) AS recall FROM (
  SELECT e.qid, count(p.vec_id) AS hits
  FROM exact e LEFT JOIN probed p ON p.qid = e.qid AND p.vec_id = e.vec_id GROUP BY e.qid) a""",
    "recall_by_scale": with_(
        UNIT, POSITIONED, sql_queries(SWEEP_QUERIES, _SMALLEST), *[ctes for ctes, _ in _BY_SCALE]
    ) + "\nUNION ALL ".join(select for _, select in _BY_SCALE),
    "knn_graph": _GRAPH + "SELECT src, dst, round(s, 6) AS sim FROM edges",
    "graph_search": _GRAPH.rstrip().replace("edges AS (", "edges AS MATERIALIZED (") + ",\n" + _WALK + f"""
SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY s DESC, c.vec_id) AS rank, c.vec_id, round(s, 6) AS sim
FROM last JOIN copies c ON c.node = last.vec_id QUALIFY rank <= {TOP_K}""",
    "method_recall": (
        _INDEX.rstrip() + ",\n" + _EDGES.replace("edges AS (", "edges AS MATERIALIZED (") + ",\n" + _WALK + f""",
walked AS (
  SELECT qid, c.vec_id FROM last JOIN copies c ON c.node = last.vec_id
  QUALIFY row_number() OVER (PARTITION BY qid ORDER BY s DESC, c.vec_id) <= {TOP_K}),
found AS (
  SELECT 'brute_force' AS method, qid, vec_id FROM exact UNION ALL SELECT 'ivf', qid, vec_id FROM probed
  UNION ALL SELECT 'graph', qid, vec_id FROM walked)
SELECT method, (SELECT count(DISTINCT qid) FROM exact) AS n_queries,
  round(count(*) / ((SELECT count(DISTINCT qid) FROM exact) * {TOP_K}), 6) AS recall
FROM found SEMI JOIN exact USING (qid, vec_id) GROUP BY method"""),
    "ivf_search_all": with_(UNIT, POSITIONED, _QUERIES, _EXACT)
    + "SELECT qid, rank, vec_id, round(sim, 6) AS sim FROM exact",
    "graph_expand": _GRAPH + "SELECT DISTINCT src AS qid, dst AS vec_id FROM edges WHERE src IN (SELECT qid FROM queries)",
}

_LABELS = " ".join(f"WHEN method = '{m}' THEN '{label}'" for m, label in METHOD_LABELS.items())
ORACLES["recall_series"] = f"SELECT CASE {_LABELS} END AS label, scale, recall FROM ({ORACLES['recall_by_scale']}) a"
ORACLES["comparison_chart"] = " UNION ".join(  # a scale that is the whole table counts once
    f"""SELECT '{label}' AS label, least({s or "count(*)"}, count(*)) AS scale, {method != "brute_force"} AS built,
  true AS timed, true AS on_log_axis, true AS has_recall FROM embeddings"""
    for method, label in METHOD_LABELS.items() for s in SCALES
)
