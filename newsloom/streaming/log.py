"""The log of a scheduled ingest: a record for each batch and each run.

A batch's record is written after its shard, into its own partition, so a replay
overwrites it. A run closes with a record of the last batch that it counted; what a
broken run left uncounted belongs to the next. The log lies beside the checkpoint,
whose batch numbers it uses.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import read_or_empty
from newsloom.sources.shards import read_shards

BATCH = "shard string, new_articles bigint, batch bigint"
RUN = "new_articles bigint, embedded_shards bigint, last_batch bigint"


def _append(spark, path, row, schema, key):
    frame = spark.createDataFrame([row], schema).coalesce(1)
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def record_batch(spark, checkpoint, batch_id: int, shard: str, new_articles: int) -> None:
    _append(spark, f"{checkpoint}-log/batches", (shard, new_articles, batch_id), BATCH, "batch")


def batches(spark, checkpoint) -> DataFrame:
    return read_or_empty(spark, f"{checkpoint}-log/batches", BATCH)


def runs(spark, checkpoint) -> DataFrame:
    """The closed runs, by the last batch that each counted; a run without a batch leaves no record."""
    return read_or_empty(spark, f"{checkpoint}-log/runs", RUN)


def uncounted(spark, checkpoint) -> tuple[int, int]:
    """(new articles, last batch) of the batches that no closed run has counted."""
    last = runs(spark, checkpoint).agg(F.coalesce(F.max("last_batch"), F.lit(-1)).alias("last"))
    row = batches(spark, checkpoint).join(F.broadcast(last), F.col("batch") > F.col("last")).agg(
        F.coalesce(F.sum("new_articles"), F.lit(0)).alias("new"), F.max("batch").alias("upto")).first()
    return row["new"], row["upto"]


def close_run(spark, checkpoint, new_articles: int, embedded_shards: int, last_batch) -> None:
    if last_batch is not None:
        _append(spark, f"{checkpoint}-log/runs", (new_articles, embedded_shards, last_batch), RUN, "last_batch")


def lost_articles(spark, checkpoint, shards_path) -> DataFrame:
    """(batch, shard, new_articles, stored) of batches whose shard holds other rows than
    the record says. Names and counts come from listing and footers. Lost links are not
    seen any more, so the next snapshot that has them brings them back."""
    stored = read_shards(spark, shards_path).groupBy("shard").agg(F.count(F.lit(1)).alias("stored"))
    joined = batches(spark, checkpoint).filter("new_articles > 0").join(stored, "shard", "left")
    joined = joined.withColumn("stored", F.coalesce("stored", F.lit(0)))
    return joined.filter("stored <> new_articles").select("batch", "shard", "new_articles", "stored")
