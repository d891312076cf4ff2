"""Search operators against plain numpy on small and on generated vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import benchmark, graph, ivf, recall, sampling, search
from newsloom.session import materialize

VECTORS = "vec_id bigint, embedding array<float>"


@pytest.fixture(scope="module")
def generated(spark):
    return spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")


@pytest.fixture(scope="module")
def queries(generated):
    return generated.filter("vec_id < 40").select(F.col("vec_id").alias("qid"), "embedding")


@pytest.fixture(scope="module")
def centres(generated):
    return materialize(ivf.sample_centroids(generated, 12), "centres")


def matrix(df):
    rows = sorted((r[0], r["embedding"]) for r in df.collect())
    x = np.array([v for _, v in rows], dtype=np.float64)
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return np.array([i for i, _ in rows]), x / np.where(norms == 0, 1, norms)


def brute(vectors, queries, k, exclude_self=False):
    ids, x = matrix(vectors)
    qids, q = matrix(queries)
    out = set()
    for qid, row in zip(qids, np.round(q @ x.T, 9)):
        ranked = sorted((-s, i) for s, i in zip(row, ids) if not (exclude_self and i == qid))
        out |= {(int(qid), r + 1, int(i), round(-s, 6)) for r, (s, i) in enumerate(ranked[:k])}
    return out


def got(df):
    return {(r["qid"], r["rank"], r["vec_id"], round(r["sim"], 6)) for r in df.collect()}


def test_exact_search(generated, queries):
    assert got(search.exact_topk(generated, queries, 10)) == brute(generated, queries, 10)


def test_exact_search_by_blocks(generated, queries):
    assert len(search.query_blocks(queries, 6000)) > 3
    for exclude_self, limit in ((False, 6000), (True, 6000), (True, -1)):
        found = search.exact_topk(generated, queries, 10, exclude_self, limit=limit)
        assert got(found) == brute(generated, queries, 10, exclude_self)


def test_ties_zero_vectors_and_small_corpora(spark):
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 1.0]), (5, None)]
    v = spark.createDataFrame(rows, VECTORS)
    q = v.filter("vec_id in (1, 2)").select(F.col("vec_id").alias("qid"), "embedding")
    want = {
        (1, 1, 1, 0.0), (1, 2, 2, 0.0), (1, 3, 3, 0.0), (1, 4, 4, 0.0),
        (2, 1, 2, 1.0), (2, 2, 3, 1.0), (2, 3, 1, 0.0), (2, 4, 4, 0.0),
    }
    assert got(search.exact_topk(v, q, 10)) == want
    assert got(search.exact_topk(v, q, 10, limit=-1)) == want
    assert search.exact_topk(v, q.limit(0), 10).count() == 0


def test_a_third_of_the_vectors_are_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 1.0, 1.0] if i % 3 == 0 else [float(x) for x in rng.normal(size=3)]) for i in range(600)]
    v = spark.createDataFrame(rows, VECTORS).repartition(8)
    q = v.filter("vec_id in (0, 1, 2)").select(F.col("vec_id").alias("qid"), "embedding")
    want = brute(v, q, 10)
    assert got(search.exact_topk(v, q, 10)) == want
    centres = materialize(ivf.sample_centroids(v, 8), "c")
    assert centres.select("embedding").distinct().count() == 8
    nodes, members = graph.build_graph(v, centres, m=8, nprobe=8)
    assert nodes.count() == 401 and members.count() == 200
    found = graph.graph_search(nodes, graph.entry_points(centres, nodes, q), q, 10, members=members)
    assert got(found) == want


def test_exact_plan_has_no_pair_join(generated, queries, plan_of):
    plan = plan_of(search.exact_topk(generated, queries, 10))
    assert "MapInArrow" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in plan


@pytest.mark.parametrize("n, nlist", [(5_000, 125), (20_000, 500), (50_000, 894), (120_582, 1388), (10, 1), (0, 1)])
def test_choose_nlist(n, nlist):
    assert ivf.choose_nlist(n) == nlist


@pytest.mark.parametrize("nlist, nprobe", [(125, 12), (500, 50), (894, 89), (1388, 138), (1, 1)])
def test_choose_nprobe(nlist, nprobe):
    assert ivf.choose_nprobe(nlist) == nprobe


def test_all_probes_give_the_exact_answer(generated, queries, centres):
    index = ivf.build_ivf(generated, centres, parts=4)
    found = ivf.ivf_search(index, queries, 10, nprobe=12)
    assert got(found) == brute(generated, queries, 10)


def test_probed_search_by_blocks(generated, queries, centres):
    index = ivf.build_ivf(generated, centres)
    want = got(ivf.ivf_search(index, queries, 10, nprobe=3))
    for limit in (-1, 9_000):  # blocks of queries and of centres
        assert got(ivf.ivf_search(index, queries, 10, nprobe=3, limit=limit)) == want


def test_large_probed_search_moves_no_vector_of_the_index(generated, queries, centres, plan_of):
    index = ivf.build_ivf(generated, centres, parts=4)
    asked = materialize(search.probe_floors(queries, centres, 3, limit=4000), "asked")
    placed = centres.join(index.places, "cell")
    own, cells, matrix = next(search.centre_blocks(placed, 3000, "part"))
    plan = plan_of(search._floor_scan(index.vectors.filter(own), asked, cells, matrix, 10, False), "simple")
    assert "Exchange" not in plan and "PartitionFilters: [" in plan and "pmod(xxhash64(part" in plan


def test_probe_floors_are_the_last_probe(generated, queries, centres):
    want = {r["qid"]: r["cell"] for r in ivf.probe_cells(queries, centres, 3).filter("rank = 3").collect()}
    for limit in (4000, 1 << 20):
        rows = search.probe_floors(queries, centres, 3, limit).collect()
        assert {r["qid"]: r["probe_cell"] for r in rows} == want


def test_samples_keep_candidates_few(generated, queries):
    """Many tasks, which would send k rows for each query and task."""
    many = materialize(generated.repartition(60), "many").repartition(60)
    calls = []

    def scan(some, asked):
        found = materialize(search._scan(some, asked, 10), "partial")
        calls.append(found.count())
        return found

    found = search.merge_topk(search.levelled(many, queries, 10, scan, rows=1000), 10)
    assert got(found) == brute(generated, queries, 10)
    assert len(calls) > 1


@pytest.mark.parametrize("count", [1, 3, 100])
def test_many_centres_go_by_the_tree(spark, generated, centres, monkeypatch, count):
    monkeypatch.setattr(ivf, "BLOCK_BYTES", 30_000)  # some blocks a shell
    odd = [(-1, [0.0] * 64), (-2, [1.0] + [0.0] * 63), (-2, [1.0] + [0.0] * 63), (-3, None)]
    vectors = generated.union(spark.createDataFrame(odd, VECTORS))
    cells = centres.select(F.col("cell").cast("bigint"), "embedding").union(
        spark.createDataFrame([(-5, [0.0] * 64), (-6, [1.0] + [0.0] * 63), (-7, [-1.0] + [0.0] * 63)], "cell bigint, embedding array<float>"))
    a = ivf.nearest_cells(vectors, cells, count).select("vec_id", "cells")
    want = sorted((r[0], tuple(r[1])) for r in a.collect())
    for limit in (-1, 3000):
        b = ivf.nearest_cells(vectors, cells, count, limit=limit).select("vec_id", "cells")
        assert sorted((r[0], tuple(r[1])) for r in b.collect()) == want


def test_inner_shells_need_fewer_centres(spark):
    """Clustered vectors: the bound spares a good part of the pairs."""
    rng = np.random.default_rng(3)
    hubs = rng.normal(size=(40, 8))
    rows = [(i, (hubs[i % 40] + 0.02 * rng.normal(size=8)).tolist()) for i in range(2000)]
    v = spark.createDataFrame(rows, VECTORS)
    cells = materialize(ivf.sample_centroids(v, 200), "c")
    seen, blocks = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    counted = ivf._streamed(1)

    def run(batches):
        def told():
            for b in batches:
                seen.add(int(b.column(3).to_numpy().sum()))
                blocks.add(len(set(zip(*(b.column(i).to_pylist() for i in range(3))))))
                yield b

        return counted(told())

    original = ivf._streamed
    ivf._streamed = lambda count: run
    try:
        b = sorted(map(tuple, ivf.assign_cells(v, cells, limit=4000).select("vec_id", "cell").collect()))
    finally:
        ivf._streamed = original
    assert b == sorted(map(tuple, ivf.assign_cells(v, cells).select("vec_id", "cell").collect()))
    assert 0 < seen.value < 0.7 * 200 * blocks.value


def test_first_keys_by_hash_threshold(spark, generated, monkeypatch):
    keys = generated.select("vec_id")
    ordered = [r["vec_id"] for r in keys.orderBy(sampling.salted_md5("vec_id", "s"), "vec_id").collect()]
    for rows in (1, 100_000):
        monkeypatch.setattr(sampling, "BUCKET_ROWS", rows)
        for n in (0, 1, 37, 300, 444, len(ordered), len(ordered) + 5):
            found = [r["vec_id"] for r in sampling.first_by_hash(keys, "vec_id", "s", n).collect()]
            assert sorted(found) == sorted(ordered[:n])


def test_search_reads_only_probed_parts(generated, queries, centres, plan_of):
    index = ivf.build_ivf(generated, centres, parts=8)
    one = queries.limit(1)
    probes = materialize(ivf.with_part(ivf.probe_cells(one, centres, 1), index.places), "p")
    assert "dynamicpruning" in plan_of(search._probed(index.vectors, probes.limit(1)), "simple").lower()


def test_trained_index(generated, queries):
    trained = ivf.train_centroids(generated, 12)
    assert trained.count() == 12
    truth = search.exact_topk(generated, queries, 10)
    found = ivf.ivf_search(ivf.build_ivf(generated, trained), queries, 10, 4)
    assert recall.recall_at_k(found, truth).first()["recall"] > 0.5
    few = ivf.train_centroids(generated, 1)
    unit = generated.filter("embedding is not null").select("embedding").collect()
    mean = np.mean([np.array(r[0]) / np.linalg.norm(r[0]) for r in unit], axis=0)
    assert few.count() == 1 and np.allclose(few.first()["embedding"], mean / np.linalg.norm(mean), atol=1e-6)


def test_held_centres_are_those_of_the_table(spark, generated):
    """Centres that the driver holds equal those that stay a table, with copies, a shared id and zero vectors."""
    rows = [(i, [1.0, float(i % 3), 0.1 * i]) for i in range(60)] + [(9, [0.0, 1.0, -1.0]), (70, [0.0, 0.0, 0.0]), (71, None)]
    odd = spark.createDataFrame(rows + [(100 + i, [1.0, 2.0, 0.2]) for i in range(30)], VECTORS)
    for vectors, nlist in ((generated, 12), (odd, 91), (odd.limit(0), 3)):
        held, table = (ivf.train_centroids(vectors, nlist, iterations=2, limit=limit).collect() for limit in (1 << 26, -1))
        assert {(r["cell"], tuple(r["embedding"])) for r in held} == {(r["cell"], tuple(r["embedding"])) for r in table}


def test_rounds_write_no_table_and_end_when_nothing_moves(spark, monkeypatch):
    written, rounds = [], []
    plain = ivf._moved
    monkeypatch.setattr(ivf, "materialize", lambda df, name, *a, **kw: written.append(name) or materialize(df, name, *a, **kw))
    monkeypatch.setattr(ivf, "_moved", lambda *a: rounds.append(1) or plain(*a))
    few = spark.createDataFrame([(i, [1.0, 0.0 + i % 2, 0.01 * i]) for i in range(20)], VECTORS)
    ivf.train_centroids(few, 2)
    assert written.count("centres") == 2 and 1 < len(rounds) < 10


@pytest.mark.parametrize("count", [1, 3, 40])
def test_nearest_centres_are_those_of_a_full_sort(count):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    m = x[:40].copy()
    m[7], m[9] = m[3], m[2] + 1e-11  # a copy, and one that is equal after rounding
    m[11] = m[4] + 1e-7  # apart in double precision only
    x[5], x[6] = 0.0, np.nan
    want = np.argsort(-np.round(x @ m.T, 9), axis=1, kind="stable")[:, :count]
    assert np.array_equal(ivf._nearest(x, m, count), want)


def test_a_scale_is_stored_before_it_is_read(generated, monkeypatch, plan_of):
    seen = []
    plain = benchmark.exact_topk
    monkeypatch.setattr(benchmark, "exact_topk", lambda vectors, *a: seen.append(vectors) or plain(vectors, *a))
    benchmark.recall_by_scale(generated, [50, None], n_queries=20)
    small, whole = seen
    assert "Join" not in plan_of(small) and not set(small.inputFiles()) & set(generated.inputFiles())
    assert small.count() == 50 and whole.inputFiles() == generated.inputFiles()


def test_graph_recall(generated, queries, centres):
    nodes, members = graph.build_graph(generated, centres, m=16, nprobe=4)
    longest = nodes.agg(F.max(F.size("neighbours"))).first()[0]
    assert longest <= 32
    truth = search.exact_topk(generated, queries, 10)
    found = graph.graph_search(nodes, graph.entry_points(centres, nodes, queries), queries, 10, members=members)
    assert recall.recall_at_k(found, truth).first()["recall"] > 0.95


def test_graph_of_all_cells_is_the_exact_graph(generated, queries, centres):
    near = ivf.nearest_cells(generated, centres, 12)
    edges = graph.knn_edges(near, 5).filter("src < 40")
    want = {(q, i) for q, _, i, _ in brute(generated, queries, 5, exclude_self=True)}
    assert {(r["src"], r["dst"]) for r in edges.collect()} == want


def test_graph_search_without_entries(generated, queries, centres):
    nodes, _ = graph.build_graph(generated, centres, m=4, nprobe=1)
    none = graph.entry_points(centres, nodes, queries).limit(0)
    assert graph.graph_search(nodes, none, queries, 10).count() == 0


def test_any_number_of_queries_walks_in_the_same_jobs(generated, centres, monkeypatch):
    """Beyond a broadcast the answer is the same, and so are the tables a walk writes."""
    nodes, members = graph.build_graph(generated, centres, m=8, nprobe=4)
    written = []
    monkeypatch.setattr(graph, "materialize", lambda df, name, *a, **kw: written.append(name) or materialize(df, name, *a, **kw))

    def walk(count, limit, popular=64):
        monkeypatch.setattr(graph, "POPULAR", popular)
        asked = generated.filter(f"vec_id < {count}").select(F.col("vec_id").alias("qid"), "embedding")
        entries = graph.entry_points(centres, nodes, asked)
        written.clear()
        found = got(graph.graph_search(nodes, entries, asked, 10, members=members, max_hops=3, limit=limit))
        return found, list(written)

    want, _ = walk(60, 1 << 26)
    few, few_tables = walk(6, 0)
    many, many_tables = walk(60, 0)
    assert many == want and few == {row for row in want if row[0] < 6} and few_tables == many_tables
    assert walk(60, 0, popular=10**9)[0] == want  # every node that is asked for twice comes to the rows
    assert not generated.sparkSession.catalog.listTables()


def test_a_large_hop_shuffles_no_node(generated, centres, plan_of):
    nodes, _ = graph.build_graph(generated, centres, m=4, nprobe=2)
    wanted = materialize(nodes.select(F.col("vec_id").alias("qid"), "vec_id", "part"), "wanted")
    table = graph.NodeTable(nodes, limit=0)
    found = table.of(wanted, "embedding", 10**9)
    plan = plan_of(found, "simple")
    assert "Bucketed: true" in plan and "ShuffledHashJoin" in plan
    assert plan.count("Exchange") == 1  # of the rows asked for
    assert plan.index("Exchange") > plan.index("Bucketed: true")
    assert found.count() == nodes.count()
    table.drop()


def test_nested_samples_nest(generated):
    p = sampling.shuffle_positions(generated)
    assert sorted(r["pos"] for r in p.select("pos").collect()) == list(range(1, 501))
    small, large = (sampling.nested_sample(p, s).select("vec_id") for s in (50, 100))
    assert small.count() == 50 and large.count() == 100 and small.exceptAll(large).count() == 0
    q = sampling.query_sample(p, [100, 50, None], 20)
    assert q.count() == 20 and q.agg(F.max("pos")).first()[0] <= 50
    for scale in (50, 100, 500):
        prefix = sampling.first_rows(generated, scale).select("vec_id")
        assert prefix.exceptAll(sampling.nested_sample(p, scale).select("vec_id")).count() == 0 and prefix.count() == scale


def test_positions_do_not_depend_on_the_buckets(generated, monkeypatch):
    want = sampling.shuffle_positions(generated.select("vec_id")).orderBy("vec_id").collect()
    assert [sampling.bucket_digits(n) for n in (0, 100_000, 100_001, 1_600_001, 10**10)] == [1, 1, 1, 2, 5]
    monkeypatch.setattr(sampling, "BUCKET_ROWS", 1)
    assert sampling.shuffle_positions(generated.select("vec_id")).orderBy("vec_id").collect() == want


def test_sampling_leaves_the_vectors_where_they_are(generated, plan_of):
    for plan in (plan_of(sampling.first_rows(generated, 100)), plan_of(sampling.query_sample(generated, [100], 10).select("qid"))):
        assert not [line for line in plan.split("\n") if line.startswith("Exchange") and "embedding" in line]
        assert "Window" not in plan


def test_recall_edges(spark):
    truth = spark.createDataFrame([(q, i) for q in range(3) for i in range(10)], "qid bigint, vec_id bigint")
    found = spark.createDataFrame([(0, i) for i in range(10)] + [(1, i) for i in range(5, 15)], "qid bigint, vec_id bigint")
    assert recall.recall_at_k(truth, truth).first()["recall"] == 1.0
    row = recall.recall_at_k(found, truth).first()
    assert (row["n_queries"], round(row["recall"], 6)) == (3, 0.5)


def test_comparison(generated):
    rows = benchmark.chart_series(benchmark.compare_searches(generated, [100, None], n_queries=10)).collect()
    assert [(r["method"], r["scale"]) for r in rows] == [
        ("brute_force", 100), ("brute_force", 500), ("graph", 100), ("graph", 500), ("ivf", 100), ("ivf", 500),
    ]
    assert all(r["recall_at_10"] == 1.0 for r in rows if r["method"] == "brute_force")
    assert all(0 <= r["recall_at_10"] <= 1 and r["avg_query_ms"] > 0 for r in rows)
    assert {r["label"] for r in rows} == {"Brute-force (exact)", "IVF (cluster-pruned)", "Graph walk"}


def test_l2_normalize(spark):
    from newsloom.functions.vectors import l2_normalize

    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0])], VECTORS).orderBy("vec_id")
    assert [r[0] for r in df.select(l2_normalize(F.col("embedding"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]
