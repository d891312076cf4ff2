"""Vector tables."""

from pyspark.sql import DataFrame

from newsloom.schemas import VECTOR_SCHEMA
from newsloom.session import read_or_empty


def read_vectors(spark, path) -> DataFrame:
    """One row per article: metadata, float vector and shard; no rows before the
    first run."""
    return read_or_empty(spark, path, VECTOR_SCHEMA)
