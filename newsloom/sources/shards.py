"""Ingest shards: one partition per run of one table."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from newsloom.schemas import CORPUS_COLUMNS, SHARD_COLUMNS, SHARD_SCHEMA
from newsloom.session import read_or_empty
from newsloom.sources.corpus import read_csv

# Parquet picks the size of the filter by the number of links in the file
LINK_FILTER = {"parquet.bloom.filter.enabled#link": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def _drop_shard(spark, path, shard):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/shard={shard}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_shard(rows: DataFrame, path, shard: str) -> int:
    """Write one run's rows as its own partition and return their number, which is
    counted while they are written. Nothing is written for none, and what an earlier
    try of the same run wrote is dropped.

    Dynamic overwrite makes a repeated write of the same shard idempotent and
    leaves all other shards alone. The files carry a Bloom filter of their links.
    """
    if rows.isEmpty():
        _drop_shard(rows.sparkSession, path, shard)
        return 0
    written = Observation()
    (
        rows.select(*SHARD_COLUMNS)
        .withColumn("shard", F.lit(shard))
        .observe(written, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite")
        .options(**LINK_FILTER)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("shard")
        .parquet(path)
    )
    return written.get["n"]


def read_shards(spark, path) -> DataFrame:
    """All shards; no rows before the first run."""
    return read_or_empty(spark, path, ", ".join(f"{c} string" for c in SHARD_COLUMNS + ["shard"]))


def read_csv_shards(spark, path) -> DataFrame:
    """Foreign shards: a folder of ``<name>.csv``; the name becomes the shard."""
    df = read_csv(spark, path, SHARD_SCHEMA)
    return df.withColumn("shard", stem(F.input_file_name()))


def stem(path_column):
    return F.regexp_extract(path_column, r"([^/]*)\.csv$", 1)


def list_shards(df: DataFrame) -> DataFrame:
    return df.select("shard").distinct()


def combined(base: DataFrame, shards: DataFrame) -> DataFrame:
    """Base corpus and all shards, matched by column name."""
    if "shard" not in base.columns:
        base = base.withColumn("shard", F.lit("base"))
    columns = CORPUS_COLUMNS + ["shard"]
    return base.select(*columns).unionByName(shards.select(*columns))
