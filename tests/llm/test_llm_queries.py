"""Every named query against its SQL on the smallest tables, and the pipeline."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"create view {name.removesuffix('.parquet')} as select * from '{FOLDER}/{name}'")
    yield connection
    connection.close()


def test_all_are_listed():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(entry.LLM_ORACLES))
def test_query_equals_sql(spark, tables, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(str([r[c] for c in columns]) for r in df.collect())
    result = tables.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(str([row[i] for i in at]) for row in result.fetchall())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    whole = docs.count()
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, FOLDER), f"test-{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        sizes.append(docs.count())
    assert whole > sizes[0] > sizes[1] > sizes[2] == sizes[3] > 0
    assert docs.filter("n_chars <> length(text)").count() == 0
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"] for r in rows} == set(texts)
    import hashlib
    assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in rows)


def test_pipeline_over_edge_rows(spark, tmp_path):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(None, None, None, None, None), (10**9, "", "en", None, 0), (10**9, "", "en", None, 0)]
    extra = spark.createDataFrame(rows, documents.schema)
    documents.unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_pipeline_over_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
