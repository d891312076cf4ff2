"""Proximity graph: build from cluster candidates, search by bounded beams.

A hop is the same few jobs for any number of queries. Nodes are stored in parts of
whole cells and the candidates of a hop carry their part, so a hop reads only the
parts it visits; a hop of more candidates than a broadcast holds meets the nodes
bucket by bucket instead.
"""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.functions.vectors import l2_normalize
from newsloom.operators.copies import split_copies
from newsloom.operators.ivf import cell_parts, index_parts, nearest_cells, with_part
from newsloom.operators.search import DIGITS, block_candidates, exact_topk, list_matrix, merge_topk, with_vector
from newsloom.schemas import EF_SEARCH, GRAPH_M, TOP_K
from newsloom.session import BROADCAST_BYTES, broadcast_if_small, fresh_path, materialize

KEY = ["qid", "vec_id", "part"]
KEY_BYTES = 48  # of one row (qid, vec_id, part) in a broadcast
BUCKET_NODES = 40_000  # nodes of one bucket, some 64 MB
POPULAR = 64  # a node that more than this share of a hop's rows ask for is sent to them


def knn_edges(near: DataFrame, m=GRAPH_M) -> DataFrame:
    """(src, dst, sim): the m nearest of each node among its nearest cells, from
    rows (vec_id, embedding, cells).

    With all cells listed this is the exact m-NN graph.
    """
    stored = near.select(F.col("cells")[0].alias("cell"), "vec_id", "embedding")
    asking = near.select(
        F.explode("cells").alias("cell"), F.col("vec_id").alias("qid"), "embedding"
    )
    ranked = merge_topk(block_candidates(stored, asking, m, exclude_self=True), m)
    return ranked.select(F.col("qid").alias("src"), F.col("vec_id").alias("dst"), "sim")


def adjacency(edges: DataFrame, m=GRAPH_M) -> DataFrame:
    """Forward and reverse edges, at most 2m per node as in the base layer of
    such a graph: the most similar ones. Hubs are cut in each task first."""
    both = edges.union(edges.select("dst", "src", "sim"))
    unique = both.groupBy("src", "dst").agg(F.max("sim").alias("sim"))
    by = Window.partitionBy("src").orderBy(F.desc("sim"), "dst")
    return (
        unique.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= 2 * m)
        .select("src", "dst", "sim")
    )


def build_graph(vectors, centroids, m=GRAPH_M, nprobe=5, parts=None) -> tuple[DataFrame, DataFrame]:
    """(nodes, members). Nodes: vec_id, unit vector, neighbours with their parts,
    stored by part."""
    nodes, members = split_copies(vectors)
    nodes = materialize(nodes, "nodes")
    if parts is None:
        parts = index_parts(nodes, centroids.count(), nodes.count())
    places = cell_parts(centroids, parts)
    near = materialize(nearest_cells(nodes, centroids, nprobe), "near-cells")
    edges = adjacency(materialize(knn_edges(near, m), "edges"), m)
    placed = with_part(near.select("vec_id", "embedding", F.col("cells")[0].alias("cell")), places)
    placed = placed.select("vec_id", "embedding", "part")
    home = placed.select(F.col("vec_id").alias("dst"), F.col("part").alias("_part"))
    lists = (
        edges.join(home, "dst")
        .groupBy(F.col("src").alias("vec_id"))
        .agg(F.collect_list(F.struct(F.col("dst").alias("vec_id"), F.col("_part").alias("part"))).alias("neighbours"))
    )
    table = placed.join(lists, "vec_id", "left").select(
        "vec_id", l2_normalize(F.col("embedding")).alias("embedding"), "neighbours", "part"
    )
    return materialize(table, "graph", partition_by="part"), members


def entry_points(centroids: DataFrame, nodes: DataFrame, queries: DataFrame, count=4) -> DataFrame:
    """(qid, vec_id, part): the nearest centres, which are corpus vectors."""
    near = exact_topk(centroids.withColumnRenamed("cell", "vec_id"), queries, count)
    near = broadcast_if_small(near.select("qid", "vec_id"), store="entries")
    return nodes.select("vec_id", "part").join(near, "vec_id").select("qid", "vec_id", "part")


def _row_dots(a: pa.Array, b: pa.Array) -> pa.Array:
    """Inner products of unit vectors row by row."""
    sims = np.einsum("ij,ij->i", list_matrix(a), list_matrix(b))
    return pa.array(np.round(sims, DIGITS))


class NodeTable:
    """The node table as the hops of a walk read it.

    Wanted rows that fit a broadcast go to the nodes, of which only the parts that
    they name are read. Any more of them are shuffled, by themselves, to a copy of
    the nodes in buckets of ids, written once. Nodes are never shuffled in a hop.
    """

    def __init__(self, nodes: DataFrame, limit=BROADCAST_BYTES):
        self.nodes, self.limit, self._bucketed = nodes, limit, None
        self.spark = nodes.sparkSession

    def fits(self, rows) -> bool:
        return rows * KEY_BYTES <= self.limit

    def bucketed(self) -> DataFrame:
        if self._bucketed is None:
            # below Spark's own number of partitions it would shuffle the buckets anew
            count = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            count = max(count, -(-self.nodes.count() // BUCKET_NODES))
            self._bucketed = "newsloom_nodes_" + uuid.uuid4().hex
            (
                self.nodes.select("vec_id", "embedding", "neighbours").repartition(count, "vec_id")
                .write.bucketBy(count, "vec_id").option("path", fresh_path(self.spark, "node-buckets"))
                .saveAsTable(self._bucketed)
            )
        return self.spark.table(self._bucketed)

    def drop(self):
        if self._bucketed is not None:
            self.spark.sql(f"DROP TABLE {self._bucketed}")  # its files go with the shared folder
            self._bucketed = None

    def of(self, wanted: DataFrame, column: str, most: int, stored=True) -> DataFrame:
        """The rows (qid, vec_id, part) with a column of their nodes. ``most`` bounds
        their number; only beyond a broadcast are the rows counted themselves."""
        if not self.fits(most):
            if not stored:
                wanted = materialize(wanted.select(*KEY), "wanted")
            most = wanted.count()
        if self.fits(most):
            # always true: Spark prunes partitions by a join only if that side is filtered
            step = F.broadcast(wanted.select(*KEY).filter("part >= 0"))
            return self.nodes.select("part", "vec_id", column).join(step, ["part", "vec_id"])
        nodes = self.bucketed().select("vec_id", column)
        # fewer than POPULAR nodes can have so many of the rows; they come to the rows
        many = wanted.groupBy("vec_id").count().filter(F.col("count") > most // POPULAR).select("vec_id").collect()
        popular = F.col("vec_id").isin([r["vec_id"] for r in many])
        rest = nodes.join(wanted.filter(~popular).hint("shuffle_hash"), "vec_id")
        if not many:
            return rest
        return rest.unionByName(wanted.filter(popular).join(F.broadcast(nodes.filter(popular)), "vec_id"))


def _unvisited(reached: DataFrame, visited: DataFrame) -> DataFrame:
    """(qid, vec_id, part) of the neighbours, once each and without the visited nodes."""
    reached = reached.select("qid", F.explode("neighbours").alias("_n")).select(
        "qid", "_n.vec_id", "_n.part", F.lit(True).alias("unseen"))
    # one shuffle both removes repeats and leaves out the visited nodes
    return (
        reached.union(visited.select(*KEY, F.lit(False).alias("unseen")))
        .groupBy(*KEY).agg(F.min("unseen").alias("unseen"))
        .filter("unseen").select(*KEY)
    )


def expand(frontier: DataFrame, nodes: DataFrame, visited: DataFrame) -> DataFrame:
    """One hop: (qid, vec_id, part) of the unvisited neighbours of a frontier that
    fits a broadcast."""
    return _unvisited(NodeTable(nodes).of(frontier, "neighbours", 0), visited)


def graph_search(
    nodes, entries, queries, k=TOP_K, ef=EF_SEARCH, members=None, max_hops=None, m=GRAPH_M, limit=BROADCAST_BYTES,
) -> DataFrame:
    """Walk from the entries, keeping the ``ef`` best nodes of each query, until
    every kept node has been expanded (or ``max_hops``).

    All queries walk together: a hop expands the newest rows of all beams in one job
    and writes the nodes it scored in another, for any number of queries. Where the
    rows of a hop outgrow ``limit`` bytes, see ``NodeTable``.
    """
    asked = with_vector(queries).select("qid", l2_normalize(F.col("embedding")).alias("_query"))
    asked = materialize(asked, "asked")
    entries = materialize(entries.select(*KEY).distinct(), "entries")
    table = NodeTable(nodes, limit)
    try:
        found = _walk(table, entries, asked, ef, max_hops, m)
    finally:
        table.drop()
    if members is not None:
        # a node stands for all its copies; only the k smallest ids can rank
        by = Window.partitionBy("node").orderBy("vec_id")
        copies = members.withColumn("_r", F.row_number().over(by)).filter(F.col("_r") <= k).drop("_r")
        copies = copies.withColumnRenamed("vec_id", "_copy")
        found = found.join(copies, found["vec_id"] == copies["node"], "left").select(
            "qid", F.coalesce("_copy", "vec_id").alias("vec_id"), "sim"
        )
    return merge_topk(found, k)


def _walk(table: NodeTable, entries, asked, ef, max_hops, m) -> DataFrame:
    """The beams (qid, vec_id, sim) of the queries at the end of their walk.

    The rows that all hops scored are the visited set, and the best of them are
    the beam. A node that enters the beam does so in the hop that scored it, so
    only the last hop's rows in the beam are still to be expanded.
    """
    walkers = asked.count()
    query = broadcast_if_small(asked, limit=table.limit)
    similarity = F.arrow_udf(_row_dots, "double")
    best = Window.partitionBy("qid").orderBy(F.desc("sim"), "vec_id")

    def score(fresh, hop, most):
        placed = table.of(fresh, "embedding", most).join(query, "qid")
        return materialize(
            placed.select(*KEY, similarity("embedding", "_query").alias("sim"), F.lit(hop).alias("hop")), "scored")

    def beam_of(rows):
        return rows.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= ef)

    hop, last = 0, score(entries, 0, entries.count())
    scored = last
    while (max_hops is None or hop < max_hops) and not last.isEmpty():
        frontier = beam_of(scored).filter(F.col("hop") == hop)
        hop += 1
        reached = table.of(frontier, "neighbours", walkers * ef, stored=False)
        fresh = materialize(_unvisited(reached, scored), "reached")
        last = score(fresh, hop, walkers * ef * 2 * m)
        scored = scored.unionByName(last)  # a hop adds its own rows, and rewrites none
    return beam_of(scored).select("qid", "vec_id", "sim")
