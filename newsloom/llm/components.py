"""Connected components of an edge table, by alternating star contractions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import materialize


def roots(edges: DataFrame, a="a", b="b") -> DataFrame:
    """(node, root) for every node that has an edge: root is the least node
    reachable, and a root is its own.

    Every round first links each node's larger neighbours to its least one, then
    the smaller neighbours (large star, small star); the rounds grow with the
    logarithm of the nodes. Minima are aggregated before their shuffle and joined
    back, so a node with very many neighbours is never gathered in one place.
    Each round is written to the shared folder.
    """
    edges = edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).distinct()
    edges, before = materialize(edges, "component-edges"), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("sum")).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.selectExpr("v as u", "u as v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").selectExpr("v as u", "m as v").filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").selectExpr("v as u", "m as v")
        edges = materialize(small.unionByName(least.selectExpr("u", "m as v")).distinct(), "component-edges")
    found = edges.selectExpr("u as node", "v as root")
    return found.unionByName(edges.selectExpr("v as node", "v as root").distinct())
