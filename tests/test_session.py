"""The package on the executors, the shared folder, scratch tables, pruned scans."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from newsloom import session
from newsloom.operators import embed
from newsloom.sources import shards

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ELSEWHERE = f"""
import os, sys
sys.path.insert(0, {ROOT!r})
from newsloom.session import build_session, scratch
from newsloom import plans
shared = os.path.abspath("shared")
os.mkdir(shared)
spark = build_session("elsewhere", **{{
    "spark.master": "local[2]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2",
    "spark.checkpoint.dir": "file://" + shared, "spark.ui.showConsoleProgress": "false"}})
for name in ("exact_topk", "knn_graph", "graph_search"):
    with scratch(spark):
        assert plans.all_queries()[name](spark, "/root/testdata/sf0.001").count() > 0
left = [f for _, _, names in os.walk(shared) for f in names]
spark.stop()
assert not left, left
print("fine")
"""


def test_queries_run_from_another_folder_and_leave_nothing(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", ELSEWHERE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]


def test_a_shared_folder_must_be_named(spark, monkeypatch):
    class Bare:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("S", (), {"getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(ValueError):
        session.shared_dir(Bare)


def test_backlog_reads_only_pending_shards(spark, plan_of):
    path = session.fresh_path(spark, "backlog")
    rows = spark.range(60).select(
        *[F.concat(F.lit(c), F.col("id").cast("string")).alias(c) for c in shards.SHARD_COLUMNS],
        F.concat(F.lit("s"), (F.col("id") % 6).cast("string")).alias("shard"),
    )
    rows.write.partitionBy("shard").parquet(path)
    stored = shards.read_shards(spark, path)
    pending = embed.backlog(stored, stored.filter("shard < 's3'").select("shard"))
    assert "dynamicpruning" in plan_of(pending, "simple").lower()
    assert {r["shard"] for r in pending.select("shard").distinct().collect()} == {"s3", "s4", "s5"}


def test_an_empty_batch_drops_what_an_earlier_try_wrote(spark):
    path = session.fresh_path(spark, "replay")
    rows = spark.range(3).select(*[F.col("id").cast("string").alias(c) for c in shards.SHARD_COLUMNS])
    assert shards.write_shard(rows, path, "a") and shards.write_shard(rows, path, "b")
    assert not shards.write_shard(rows.limit(0), path, "a")
    assert {r["shard"] for r in shards.read_shards(spark, path).select("shard").distinct().collect()} == {"b"}


def test_manifest_keeps_the_order_of_first_appearance(spark):
    from newsloom.sources import manifest

    links = spark.createDataFrame([("b",), (" a ",), ("b",), ("",), (None,), ("c",), ("a",)], "link string").coalesce(1)
    more = spark.createDataFrame([("0",), ("c",)], "link string").coalesce(1)
    assert [r["link"] for r in manifest.build_manifest(links, more).collect()] == ["b", "a", "c", "0"]


def test_csv_columns_go_by_the_header(spark, tmp_path):
    from newsloom.sources import corpus

    (tmp_path / "x.csv").write_text('category,link,extra\n"c, d",l1,e\nNA,l2,\n')
    rows = corpus.read_csv(spark, str(tmp_path / "x.csv")).select("link", "category", "date").collect()
    assert [tuple(r) for r in rows] == [("l1", "c, d", None), ("l2", None, None)]
