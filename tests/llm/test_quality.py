import zlib

import numpy as np

from newsloom.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = Q.query(spark, SF).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50 and sum(a == b for a, b in held) >= 0.97 * len(held)


def test_held_out_labels_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 300")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    flipped = labels.select(
        "doc_id", (Q.F.when(Q.held_out(), 1 - Q.F.col("quality")).otherwise(Q.F.col("quality"))).alias("quality"))
    plain = Q.assess(docs, labels).orderBy("doc_id").collect()
    assert plain == Q.assess(docs, flipped).orderBy("doc_id").collect()


def test_scores_are_density_differences():
    rng = np.random.default_rng(1)
    d = Q.N_STATISTICS
    x = {0: rng.normal(0, 1, (300, d)), 1: rng.normal(0.7, 2, (500, d))}
    model = Q.fit({k: np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()]) for k, v in x.items()})
    point = rng.normal(0.3, 1, (4, d))
    pooled = sum(len(v) * np.cov(v.T, bias=True) for v in x.values()) / 800
    odds = []
    for k in (0, 1):
        cov = (1 - Q.SHRINK_POOLED) * np.cov(x[k].T, bias=True) + Q.SHRINK_POOLED * pooled
        cov = (1 - Q.SHRINK_DIAGONAL) * cov + Q.SHRINK_DIAGONAL * np.diag(np.diag(cov)) + Q.RIDGE * np.eye(d)
        diff = point - x[k].mean(0)
        mahalanobis = np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff)
        odds.append(np.log(len(x[k]) / 800) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * mahalanobis)
    assert np.allclose(model.log_odds(point), odds[1] - odds[0])


ROWS = [(None, None), (1, ""), (2, " \n\t"), (3, "a" * 200000), (4, "ok text here"), (4, "ok text here"), (5, "\x00é日"),
        (6, "!!! ### |||")]


def test_edge_texts_and_missing_classes(spark):
    docs = spark.createDataFrame([(*r, 0.5) for r in ROWS], "doc_id long, text string, score double")
    for labels, constant in (([], 0.5), ([(4, 1)], None), ([(4, 1), (6, 0), (6, None), (5, 7), (None, 1), (4, 1)], None)):
        table = spark.createDataFrame(labels, "doc_id long, quality int")
        rows = Q.assess(docs, table).collect()
        assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
        if constant:
            assert {r["score"] for r in rows} == {constant}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert Q.assess(empty, spark.createDataFrame([], "doc_id long, quality int")).collect() == []


def test_keep_good(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = Q.keep_good(docs, labels)
    want = {r["doc_id"] for r in Q.assess(docs, labels).filter("predicted = 1").collect()}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == want
