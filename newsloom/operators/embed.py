"""Embedding of articles: pluggable encoder, backlog of shards, parity check.

An encoder factory is a function without arguments that returns
``encode(texts: list[str]) -> 2-d float array``. It runs once per task, on the
executor, so a model is loaded there and never shipped from the driver.
"""

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from newsloom.schemas import BATCH_SIZE, META_COLUMNS
from newsloom.session import broadcast_if_small, materialize
from newsloom.sources.shards import read_shards
from newsloom.sources.vectors import read_vectors

VECTOR = T.ArrayType(T.FloatType(), False)
HASHED_DIMENSIONS = 64


def hash_encoder(d: int = HASHED_DIMENSIONS) -> Callable:
    """Factory for the default encoder, which needs no model: a unit-length
    hashed bag of words over the whole text.

    A word's bucket is the first 32 bits of its MD5 modulo ``d``.
    """

    def buckets(words):
        """The bucket of each distinct word, hashed once."""
        digests = (hashlib.md5(w.encode("utf-8"), usedforsecurity=False).digest() for w in words)
        return np.fromiter((int.from_bytes(x[:4], "big") % d for x in digests), np.int64, len(words))

    def factory():
        def encode(texts):
            lists = [text.lower().split() for text in texts]
            # Arrow numbers the distinct words of the batch
            coded = pa.array(chain.from_iterable(lists), pa.string()).dictionary_encode()
            places = np.repeat(np.arange(len(texts)) * d, [len(words) for words in lists])
            cells = places + buckets(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            counts = np.bincount(cells, minlength=len(texts) * d).reshape(len(texts), d).astype(float)
            norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
            return np.divide(counts, norms, out=counts, where=norms > 0)

        return encode

    return factory


def encoder_udf(factory: Callable, batch_size: int = BATCH_SIZE):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = factory()
        for texts in batches:
            vectors = []
            for i in range(0, len(texts), batch_size):
                block = encode(texts.iloc[i : i + batch_size].tolist())
                vectors.extend(np.asarray(block, dtype=np.float32))
            yield pd.Series(vectors, dtype=object)

    # marked so that the optimizer never copies an encoder call into a filter
    return F.pandas_udf(run, VECTOR).asNondeterministic()


def embed(df: DataFrame, factory=None, text="text_original", batch_size=BATCH_SIZE) -> DataFrame:
    """Add ``embedding``; null text is embedded as an empty one. Only the text
    column goes to Python, in Arrow batches."""
    encode = encoder_udf(factory or hash_encoder(), batch_size)
    return df.withColumn("embedding", encode(F.coalesce(F.col(text), F.lit(""))))


def vectors_of(df: DataFrame, factory=None) -> DataFrame:
    """Metadata and vector in one row, so nothing depends on row positions."""
    keep = META_COLUMNS + (["shard"] if "shard" in df.columns else [])
    return embed(df, factory).select(*keep, "embedding")


def _pending(shards: DataFrame, embedded: DataFrame) -> DataFrame:
    """Shards with fewer vectors than articles. The shard is a partition and nothing
    else is selected, so a scan of files takes names and counts from listing and footers."""
    articles = shards.groupBy("shard").agg(F.count(F.lit(1)).alias("articles"))
    vectors = embedded.groupBy("shard").agg(F.count(F.lit(1)).alias("vectors"))
    return articles.join(vectors, "shard", "left").filter("vectors is null or vectors < articles").select("shard")


def unembedded_shards(shards: DataFrame, embedded: DataFrame) -> DataFrame:
    """Shard names that lack vectors, in order: all of theirs, or some after a write was cut short."""
    return _pending(shards, embedded).orderBy("shard")


def backlog(articles: DataFrame, embedded: DataFrame) -> DataFrame:
    """Articles of shards that lack vectors. The list of pending shard names is
    broadcast after a check, and prunes the shard partitions of the scan."""
    # the filter is always true: Spark prunes by a join only if that side is filtered
    pending = materialize(_pending(articles, embedded), "pending").filter("shard >= ''")
    return articles.join(broadcast_if_small(pending), "shard", "left_semi")


def incremental_embed(articles: DataFrame, embedded: DataFrame, factory=None) -> DataFrame:
    return vectors_of(backlog(articles, embedded), factory)


def write_vectors(vectors: DataFrame, path: str) -> None:
    """One partition per shard; only the shards being written are replaced."""
    (
        vectors.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("shard")
        .parquet(path)
    )


def embed_backlog(spark, shards_path, vectors_path, factory=None) -> int:
    """Embed every shard that lacks vectors; returns how many there were.

    Safe to run again at any time. With nothing pending no model is loaded.
    """
    articles, embedded = read_shards(spark, shards_path), read_vectors(spark, vectors_path)
    pending = _pending(articles, embedded).count()
    if pending:
        write_vectors(incremental_embed(articles, embedded, factory), vectors_path)
    return pending


def vector_meta_parity(vectors: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """One row: row counts and the keys found on one side only."""
    sides = vectors.select(F.col(key), F.lit(1).alias("v"), F.lit(0).alias("m")).unionByName(
        meta.select(F.col(key), F.lit(0).alias("v"), F.lit(1).alias("m"))
    )
    per_key = sides.groupBy(key).agg(F.sum("v").alias("v"), F.sum("m").alias("m"))
    return per_key.agg(
        F.coalesce(F.sum("v"), F.lit(0)).alias("n_vectors"),
        F.coalesce(F.sum("m"), F.lit(0)).alias("n_meta"),
        F.coalesce(F.sum(F.when(F.col("m") == 0, F.col("v"))), F.lit(0)).alias("vectors_without_meta"),
        F.coalesce(F.sum(F.when(F.col("v") == 0, F.col("m"))), F.lit(0)).alias("meta_without_vector"),
    )


def with_position(df: DataFrame, order) -> DataFrame:
    """Row number 0, 1, ... by ``order`` without a one-task sort.

    Rows are sorted by range over all tasks; each task numbers its own rows
    and adds the row counts of the tasks before it.
    """
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = df.repartitionByRange(int(parts), *order)
    numbered = materialize(
        ranged.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()),
        "positions",
    )
    task = F.shiftright("_id", 33)
    sizes = numbered.groupBy(task.alias("_task")).count()
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # one row per task, so this window is as small as the number of tasks
    starts = sizes.select(
        "_task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    )
    return (
        numbered.withColumn("_task", task)
        .join(F.broadcast(starts), "_task")
        .withColumn("position", F.col("_start") + F.col("_id") % F.lit(1 << 33))
        .drop("_id", "_task", "_start")
    )


def with_stored_position(spark, path) -> DataFrame:
    """A stored Parquet table with the place 0, 1, ... of each row in its files, read in
    the order of their names.

    Parquet's readers know the index of a row in its file, and the files' row counts
    follow from it without reading a column. Only one row per file is gathered; the
    table's rows are neither sorted nor shuffled, also where they are all alike.
    """
    rows = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = rows.groupBy("_file").agg((F.max("_row") + 1).alias("_n"))
    # a longer name has a higher number
    before = Window.orderBy(F.length("_file"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = rows.join(broadcast_if_small(starts, store="file-starts"), "_file")
    return placed.withColumn("position", F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")


def join_stored(spark, vectors_path, meta_path) -> DataFrame:
    """Row i of one stored table with row i of another."""
    return _joined(with_stored_position(spark, vectors_path), with_stored_position(spark, meta_path))


def join_by_position(vectors: DataFrame, meta: DataFrame, vector_order, meta_order) -> DataFrame:
    """Row i with row i for foreign data that is tied by position only."""
    return _joined(with_position(vectors, vector_order), with_position(meta, meta_order))


def _joined(left: DataFrame, right: DataFrame) -> DataFrame:
    n, m = left.count(), right.count()
    if n != m:
        raise ValueError(f"row count mismatch: {n} vectors and {m} metadata rows")
    clash = set(left.columns) & set(right.columns) - {"position"}
    return left.join(right.drop(*clash), "position")
