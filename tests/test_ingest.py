"""Ingest rules, the scheduled run, and replays."""

import pytest
from pyspark.sql import functions as F

from newsloom.operators import embed, ingest
from newsloom.sources import shards
from newsloom.sources.vectors import read_vectors
from newsloom.streaming import ingest as job
from newsloom.streaming import log

ENTRY = "link string, title string, published string, category string, content string"
LONG = "word " * 10  # 49 characters once stripped


def entries(spark, *rows):
    return spark.createDataFrame([(k, "t", "Fri, 24 Feb 2022 23:30:00 +0200", "c", c) for k, c in rows], ENTRY)


@pytest.fixture
def pull(spark):
    return entries(
        spark, ("new", f"<p>{LONG}xx</p>"), ("seen", f"<p>{LONG}xx</p>"), ("c49", f"<p>{LONG}</p>"),
        ("c50", f"<p>{LONG.strip()}x</p>"), ("seen-empty", ""), ("twice", f"{LONG}xx"), ("twice", f"{LONG}yy"),
        (None, f"{LONG}xx"),
    )


@pytest.fixture
def seen(spark):
    return spark.createDataFrame([("seen",), ("seen-empty",), (None,), ("seen",)], "link string")


def test_new_articles(pull, seen):
    got = ingest.new_articles(pull, seen)
    assert sorted(str(r["link"]) for r in got.collect()) == ["None", "c50", "new", "twice", "twice"]
    row = got.filter("link = 'new'").first()
    assert (row["date"], row["title_ukrainian"], row["category"]) == ("24.02.2022", "", "c")


def test_dedupe_within_batch_keeps_one(pull, seen):
    got = ingest.new_articles(pull, seen, dedupe_within_batch=True)
    assert sorted(str(r["link"]) for r in got.collect()) == ["None", "c50", "new", "twice"]


def test_big_batches_take_the_shuffle_path(pull, seen, monkeypatch):
    want = sorted(str(r["link"]) for r in ingest.new_articles(pull, seen).collect())
    monkeypatch.setattr(ingest, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(ingest, "broadcast_if_small", lambda df, store: df)
    assert sorted(str(r["link"]) for r in ingest.new_articles(pull, seen).collect()) == want


def test_text_function_option(pull, seen):
    rows = ingest.new_articles(pull, seen, to_text=lambda c: F.concat(F.lit("own "), c)).collect()
    assert rows and all(r["text_original"].startswith("own ") for r in rows)


def test_funnel_tests_length_before_seen(pull, seen):
    rows = ingest.ingest_funnel(ingest.ingest_outcomes(pull, seen)).collect()
    assert {r["outcome"]: r["items"] for r in rows} == {"fetched": 8, "new": 5, "no_content": 2, "already_seen": 1}


def test_seen_table_is_not_shuffled(spark, pull, plan_of, tmp_path):
    spark.range(1000).select(F.col("id").cast("string").alias("link")).write.parquet(str(tmp_path / "seen"))
    plan = plan_of(ingest.seen_among(pull, spark.read.parquet(str(tmp_path / "seen"))))
    join = plan[: plan.index("Scan parquet")]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in join


def test_preview(pull):
    row = ingest.feed_preview(ingest.feed_articles(pull)).filter("link = 'c49'").first()
    assert (row["text_len"], row["status"]) == (49, "skip")


def rows_scanned(df):
    """Rows that the scans of an executed query gave."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = 0, [plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getName() else plan]
    while todo:
        node = todo.pop()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in node.getClass().getName():
            todo.append(node.plan())
        if "FileSourceScan" in node.getClass().getName():
            found += node.metrics().apply("numOutputRows").value()
    return found


def test_shards_without_the_links_are_not_read(spark, tmp_path):
    path = str(tmp_path / "shards")
    for i in range(6):
        rows = spark.range(i * 1000, i * 1000 + 500).select(
            F.md5(F.col("id").cast("string")).alias("link"), *[F.lit("x").alias(c) for c in shards.SHARD_COLUMNS if c != "link"])
        assert shards.write_shard(rows.coalesce(1), path, f"s{i}") == 500
    stored = shards.read_shards(spark, path).select("link")
    asked = spark.range(3010, 3040).select(F.md5(F.col("id").cast("string")).alias("link"))
    pruned = ingest.seen_among(asked, stored)
    whole = ingest.seen_among(asked, stored, asked=5)
    links = lambda df: sorted(r["link"] for r in df.collect())
    assert links(pruned) == links(whole) == links(asked)
    assert rows_scanned(pruned) < rows_scanned(whole) == 3000 + 30
    none = spark.createDataFrame([(None,)], "link string")
    assert ingest.seen_among(none, stored).collect() == []


# --- the scheduled run -----------------------------------------------------------

ITEM = "<item><title>{0}</title><link>{0}</link><pubDate>Fri, 24 Feb 2022 23:30:00 GMT</pubDate><content:encoded><![CDATA[{1}]]></content:encoded></item>"


def snapshot(folder, name, items):
    body = "".join(ITEM.format(*item) for item in items)
    (folder / name).write_text(
        f'<rss xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>{body}</channel></rss>'
    )


@pytest.fixture
def run(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    base = spark.createDataFrame([("old",)], "link string")
    paths = [str(tmp_path / n) for n in ("shards", "vectors", "checkpoint")]

    def once():
        return tuple(job.run_once(spark, str(feed), base, *paths).first())

    return once, feed, paths, base


def test_scheduled_runs(spark, run):
    once, feed, (shard_path, vector_path, _), _ = run
    full = f"<p>{LONG}body</p>"
    snapshot(feed, "1.xml", [("old", full), ("a", full), ("b", ""), ("a", full)])
    assert once() == (1, 1)
    # nothing new has landed
    assert once() == (0, 0)
    # b is finished now, a comes again
    snapshot(feed, "2.xml", [("a", full), ("b", full)])
    assert once() == (1, 1)
    # an unchanged feed
    snapshot(feed, "3.xml", [("a", full), ("b", full)])
    assert once() == (0, 0)
    stored = shards.read_shards(spark, shard_path)
    assert sorted(r["link"] for r in stored.collect()) == ["a", "b"]
    vectors = read_vectors(spark, vector_path)
    assert vectors.count() == 2 and vectors.select("shard").distinct().count() == 2


def test_a_replayed_batch_changes_nothing(spark, run):
    _, feed, (shard_path, _, _), base = run
    from newsloom.sources.feeds import read_feed

    full = f"<p>{LONG}body</p>"
    snapshot(feed, "1.xml", [("a", full)])
    snapshot(feed, "2.xml", [("a", full), ("b", full)])
    batches = [read_feed(spark, str(feed / n)) for n in ("1.xml", "2.xml")]
    for batch_id in (0, 1, 1, 0, 1):
        job.ingest_batch(batches[batch_id], batch_id, base, shard_path)
    stored = shards.read_shards(spark, shard_path)
    assert sorted((r["link"], r["shard"][-1]) for r in stored.collect()) == [("a", "0"), ("b", "1")]


def test_log_counts_what_a_broken_run_left(spark, run):
    once, feed, (shard_path, vector_path, checkpoint), base = run
    full = f"<p>{LONG}body</p>"
    snapshot(feed, "1.xml", [("a", full), ("b", full)])
    job.start_ingest(spark, str(feed), base, shard_path, checkpoint).awaitTermination()  # no summary
    assert log.uncounted(spark, checkpoint) == (2, 0)
    snapshot(feed, "2.xml", [("c", full), ("a", full)])
    assert once() == (3, 2) and log.uncounted(spark, checkpoint) == (0, None)
    assert [tuple(r) for r in log.runs(spark, checkpoint).collect()] == [(3, 2, 1)]
    # a shard is lost, and the next snapshot brings its links back
    assert log.lost_articles(spark, checkpoint, shard_path).count() == 0
    shard = log.batches(spark, checkpoint).filter("batch = 0").first()["shard"]
    shards._drop_shard(spark, shard_path, shard)
    assert [tuple(r) for r in log.lost_articles(spark, checkpoint, shard_path).collect()] == [(0, shard, 2, 0)]
    snapshot(feed, "3.xml", [("c", full), ("a", full), ("b", full)])
    assert once() == (2, 1)
    assert sorted(r["link"] for r in shards.read_shards(spark, shard_path).collect()) == ["a", "b", "c"]


# --- embedding -------------------------------------------------------------------

def test_backlog_only(spark, tmp_path):
    shard_path, vector_path = str(tmp_path / "s"), str(tmp_path / "v")
    cols = "link string, date string, title_original string, title_ukrainian string, text_original string, text_ukrainian string, category string"
    for i in range(3):
        rows = spark.createDataFrame([(f"l{i}", "d", "t", "", f"text {i}", "", "c")], cols)
        shards.write_shard(rows, shard_path, f"s{i}")
    stored = shards.read_shards(spark, shard_path)
    embed.write_vectors(embed.vectors_of(stored.filter("shard = 's1'")), vector_path)
    pending = embed.unembedded_shards(stored, read_vectors(spark, vector_path))
    assert [r["shard"] for r in pending.collect()] == ["s0", "s2"]
    assert embed.embed_backlog(spark, shard_path, vector_path) == 2
    assert embed.embed_backlog(spark, shard_path, vector_path) == 0
    assert read_vectors(spark, vector_path).count() == 3
    assert embed.embed_backlog(spark, str(tmp_path / "absent"), vector_path) == 0


def test_half_written_vectors_are_pending(spark, tmp_path, plan_of):
    shard_path, vector_path = str(tmp_path / "s"), str(tmp_path / "v")
    rows = spark.range(4).select(
        F.concat(F.lit("l"), "id").alias("link"), *[F.lit("x").alias(c) for c in shards.SHARD_COLUMNS if c != "link"])
    shards.write_shard(rows, shard_path, "s0")
    stored = shards.read_shards(spark, shard_path)
    embed.write_vectors(embed.vectors_of(stored.filter("link < 'l2'")), vector_path)
    assert embed.embed_backlog(spark, shard_path, vector_path) == 1
    assert read_vectors(spark, vector_path).select("link").distinct().count() == 4
    assert embed.embed_backlog(spark, shard_path, vector_path) == 0
    plan = plan_of(embed.unembedded_shards(stored, read_vectors(spark, vector_path)))
    assert plan.count("ReadSchema: struct<>") == 2  # no column is read


def test_factory_runs_once_per_task_in_batches(spark):
    seen = spark.sparkContext.accumulator(0)
    sizes = spark.sparkContext.accumulator(0)

    def factory():
        import numpy as np

        seen.add(1)

        def encode(texts):
            assert len(texts) <= 128
            sizes.add(len(texts))
            return np.array([[len(t), 1.0] for t in texts])

        return encode

    df = spark.range(0, 1000, 1, 2).select(F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("text_original"))
    rows = embed.embed(df, factory).collect()
    assert all(r["embedding"] == [len(r["text_original"]), 1.0] for r in rows)
    assert (seen.value, sizes.value) == (2, 1000)


def test_hashed_encoder(spark):
    df = spark.createDataFrame([("a b a",), ("",), (None,), ("A  B a",)], "text_original string")
    rows = [r["embedding"] for r in embed.embed(df).collect()]
    assert abs(sum(x * x for x in rows[0]) - 1) < 1e-6
    assert rows[0] == rows[3] and set(rows[1]) == set(rows[2]) == {0.0}


def test_encoder_is_not_copied_into_a_filter(spark, plan_of):
    df = spark.createDataFrame([("a",)], "text_original string")
    plan = plan_of(embed.embed(df).select(F.explode("embedding").alias("x")).filter("x > 0"), "simple")
    assert plan.count("ArrowEvalPython") == 1


def test_parity_and_positions(spark):
    v = spark.createDataFrame([(1, "v1"), (2, "v2"), (4, "v4")], "key int, v string")
    m = spark.createDataFrame([(1, "m1"), (3, "m3"), (4, "m4")], "key int, m string")
    assert tuple(embed.vector_meta_parity(v, m, "key").first()) == (3, 3, 1, 1)
    rows = embed.join_by_position(v, m, ["key"], ["key"]).orderBy("position").collect()
    assert [(r["position"], r["v"], r["m"]) for r in rows] == [(0, "v1", "m1"), (1, "v2", "m3"), (2, "v4", "m4")]
    with pytest.raises(ValueError, match="mismatch"):
        embed.join_by_position(v, m.limit(2), ["key"], ["key"])
