"""Recall of an approximate search against the exact one."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.schemas import TOP_K


def hits_per_query(predicted: DataFrame, truth: DataFrame, k: int = TOP_K) -> DataFrame:
    """Each query of the truth with its share of found neighbours, out of k."""
    found = predicted.select("qid", "vec_id").withColumn("_hit", F.lit(1))
    return (
        truth.select("qid", "vec_id")
        .join(found, ["qid", "vec_id"], "left")
        .groupBy("qid")
        .agg((F.count("_hit") / k).alias("recall"))
    )


def recall_at_k(predicted: DataFrame, truth: DataFrame, k: int = TOP_K) -> DataFrame:
    """One row: mean recall over all queries; a query without a hit counts as 0."""
    return hits_per_query(predicted, truth, k).agg(
        F.count("*").alias("n_queries"), F.avg("recall").alias("recall")
    )
