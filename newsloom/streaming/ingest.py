"""Scheduled ingest: landed feed snapshots to shards, then the embedding backlog.

One scheduled run is one ``availableNow`` query. The state across runs is the
set of seen links, read from the base corpus and the other shards: a batch that
runs twice writes the same partition twice. The log only counts.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import shard_stamp
from newsloom.operators.embed import embed_backlog
from newsloom.operators.ingest import new_articles, run_summary
from newsloom.schemas import MIN_CONTENT_CHARS
from newsloom.session import materialize, scratch
from newsloom.sources.feeds import feed_entries, stream_feed
from newsloom.sources.shards import read_shards, write_shard
from newsloom.streaming import log


def seen_links(spark, base_links: DataFrame, shards_path: str, but_shard: str) -> DataFrame:
    """Links of the base corpus and of every shard except ``but_shard``."""
    others = read_shards(spark, shards_path).filter(F.col("shard") != but_shard)
    return base_links.select("link").union(others.select("link"))


def shard_name(entries: DataFrame, batch_id: int) -> str:
    """UTC stamp of the newest snapshot of the batch, and the batch number.

    Both are fixed per batch, so a replayed batch overwrites its own partition;
    names sort by time.
    """
    stamp = entries.agg(shard_stamp(F.max("landed")).alias("stamp")).first()["stamp"]
    return f"{stamp}-{batch_id:010d}"


def ingest_batch(
    items: DataFrame, batch_id: int, base_links: DataFrame, shards_path: str,
    markers=None, min_chars=MIN_CONTENT_CHARS, checkpoint: str | None = None,
) -> str | None:
    """Ingest one batch; returns the shard that holds its articles, if there are any.
    With ``checkpoint`` the batch is recorded in the log beside it. What the batch stored
    in between is dropped at its end."""
    spark = items.sparkSession
    with scratch(spark):
        entries = materialize(feed_entries(items), "feed-entries")
        shard = shard_name(entries, batch_id)
        seen = seen_links(spark, base_links, shards_path, shard)
        # kept apart from the target, which the seen links are read from
        fresh = materialize(
            new_articles(entries, seen, markers, min_chars, dedupe_within_batch=True), "fresh-articles"
        )
        new = write_shard(fresh, shards_path, shard)
    if checkpoint:
        log.record_batch(spark, checkpoint, batch_id, shard, new)
    return shard if new else None


def start_ingest(
    spark, feed_path: str, base_links: DataFrame, shards_path: str, checkpoint: str,
    markers=None, min_chars=MIN_CONTENT_CHARS, max_files=None, read=stream_feed,
):
    """Start one scheduled run; it stops when all landed snapshots are read.

    An unfinished item is not remembered, so it is taken when a later snapshot
    has its text.
    """

    def run(items, batch_id):
        ingest_batch(items, batch_id, base_links, shards_path, markers, min_chars, checkpoint)

    return (
        read(spark, feed_path, max_files)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_once(
    spark, feed_path, base_links, shards_path, vectors_path, checkpoint, factory=None, **options
) -> DataFrame:
    """Ingest what has landed, embed what has no vectors, return the summary.

    New articles are those of the batches in the log that no run has counted yet, so the
    batches of a run that broke off before its summary count in the next one. No shard is read.
    """
    start_ingest(spark, feed_path, base_links, shards_path, checkpoint, **options).awaitTermination()
    new, last_batch = log.uncounted(spark, checkpoint)
    embedded = embed_backlog(spark, shards_path, vectors_path, factory)
    log.close_run(spark, checkpoint, new, embedded, last_batch)
    return run_summary(spark, new, embedded)
