"""From raw documents to token ids: five stages, each a whole operator.

A stage takes (spark, docs, sf_dir) and returns a table with the columns of
``documents``; the last returns the tokens. Between stages the table is written
to the shared folder and read again, so that no stage is run twice and a lost
executor costs a re-read.
"""

import functools

from pyspark.sql import functions as F

from newsloom.llm import bpe, quality, secret_scan, simhash, winnow
from newsloom.session import materialize

BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}
REMEMBERED = 50_000  # words of a worker's memory, next to what earlier stages left in its executor


def bounded_batches(stage):
    """Stages hand texts to Python in batches of bounded size: the workers of several
    stages share an executor's memory, and what they once held they keep."""

    @functools.wraps(stage)
    def run(spark, docs, sf_dir):
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)

    return run


@bounded_batches
def good(spark, docs, sf_dir):
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@bounded_batches
def unique(spark, docs, sf_dir):
    """One document of each group of near copies, which are those of the SimHash operator."""
    return simhash.keep_one(docs)


@bounded_batches
def clean_of_benchmark(spark, docs, sf_dir):
    """Documents without any passage of the benchmark."""
    return winnow.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@bounded_batches
def without_secrets(spark, docs, sf_dir):
    """All documents, with a mark in place of every secret."""
    cleaned = secret_scan.redact(secret_scan.scan(docs))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length(F.col("text")).cast(docs.schema["n_chars"].dataType))
    return cleaned.select(docs.columns)


@bounded_batches
def tokens(spark, docs, sf_dir):
    """Token ids, with digests of them and of the decoded text."""
    vocabulary = bpe.public_vocabulary(spark, remembered=REMEMBERED)
    encoded = bpe.with_digests(docs.select("doc_id", "text"), vocabulary)
    return encoded.select(
        "doc_id", "tokens.ids", F.size("tokens.ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("tokens.ids", ","), 256).alias("ids_sha256"), "tokens.decoded_sha256",
    )


STAGES = [
    ("quality", good),
    ("near_duplicates", unique),
    ("decontamination", clean_of_benchmark),
    ("secrets", without_secrets),
    ("bpe", tokens),
]

# The classifier is trained and the links are iterative, which SQL can't express.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
