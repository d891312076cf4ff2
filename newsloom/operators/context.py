"""Passages for a question: the retrieval step over the combined corpus."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.embed import embed
from newsloom.operators.search import exact_topk
from newsloom.session import broadcast_if_small, materialize


def nearest_articles(vectors: DataFrame, questions: DataFrame, k=5, factory=None) -> DataFrame:
    """(qid, rank, vec_id, sim) for questions (qid, text) among stored vectors
    (vec_id, embedding) of the same encoder. Only the questions are embedded."""
    asked = materialize(embed(questions, factory, text="text").select("qid", "embedding"), "questions")
    return exact_topk(vectors.select("vec_id", "embedding"), asked, k)


def cited_context(neighbours: DataFrame, articles: DataFrame, key="ord") -> DataFrame:
    """One row per question: its k articles in rank order, each with number,
    title and link. The k rows per question are joined to the articles, which
    are not shuffled while those rows fit a broadcast."""
    hits = broadcast_if_small(neighbours.select("qid", "rank", F.col("vec_id").alias(key)), "hits")
    passage = F.concat(
        F.lit("["), F.col("rank").cast("string"), F.lit("] "), F.coalesce("title_original", F.lit("")),
        F.lit(" ("), F.coalesce("link", F.lit("")), F.lit(")\n"), F.coalesce("text_original", F.lit("")),
    )
    ranked = F.sort_array(F.collect_list(F.struct("rank", passage.alias("passage"))))
    return (
        articles.select(key, "title_original", "link", "text_original")
        .join(hits, key)
        .groupBy("qid")
        .agg(F.array_join(F.transform(ranked, lambda s: s["passage"]), "\n\n").alias("context"),
             F.count("*").alias("passages"))
    )
