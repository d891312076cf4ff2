"""Equal vectors: one representative each, and who shares it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.search import with_vector
from newsloom.session import broadcast_if_small, materialize


def split_copies(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, members): equal vectors share one node, the smallest id; members
    (node, vec_id) lists the vectors of repeated ones.

    Only hashes are grouped for all rows. Vectors whose hash occurs twice are then
    compared themselves, so two vectors that happen to share a hash stay apart.
    """
    usable = with_vector(vectors).select("vec_id", "embedding")
    mark = F.xxhash64("embedding").alias("_h")
    counts = usable.select(mark).groupBy("_h").agg(F.count("*").alias("n"))
    repeated = broadcast_if_small(counts.filter("n > 1").select("_h"), store="repeated-hashes")
    suspects = materialize(usable.select("*", mark).join(repeated, "_h").drop("_h"), "repeated-vectors")
    groups = suspects.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"))
    groups = broadcast_if_small(groups.filter("n > 1").select("embedding", "node"), store="copies")
    members = suspects.join(groups, "embedding").select("node", "vec_id")
    others = broadcast_if_small(members.filter("vec_id <> node").select("vec_id"), store="copy-ids")
    return usable.join(others, "vec_id", "left_anti"), members
