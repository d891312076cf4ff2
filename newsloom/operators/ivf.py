"""Cluster-pruned index: choose or train centres, assign cells, search."""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.vectors import dot, l2_normalize
from newsloom.operators.copies import split_copies
from newsloom.operators.sampling import first_by_hash
from newsloom.operators.search import (
    BLOCK_BYTES, DIGITS, PRODUCT_CELLS, BestK, exact_topk, floor_topk, list_matrix, probe_floors, probed_topk, unit_matrix,
    unit_rows, with_vector,
)
from newsloom.schemas import NPROBE_FRACTION, SEED, TOP_K
from newsloom.session import BROADCAST_BYTES, broadcast_if_small, fits_broadcast, materialize

PART_BYTES = 64 * 1024 * 1024
SHELLS = 16  # angles from a coarse centre that are told apart
SUM_LEVEL = 64  # rows of a cell that are added up at a time on the first level
PROBE_BYTES = 64  # of a row (qid, rank, cell, part), about


def choose_nlist(n: int) -> int:
    """Cells for n vectors: 4 * sqrt(n), at least 40 vectors to a cell."""
    return max(1, min(int(4 * math.sqrt(n)), max(1, n // 40)))


def choose_nprobe(nlist: int) -> int:
    return max(1, int(nlist * NPROBE_FRACTION))


def sample_centroids(vectors: DataFrame, nlist: int, seed: int = SEED) -> DataFrame:
    """``nlist`` corpus vectors as centres, picked by hash order; the cell is the
    id of its centre. Copies of one vector count once, so a vector that fills a
    third of the corpus still gets one cell."""
    nodes, _ = split_copies(vectors)
    ids = first_by_hash(nodes.select(F.col("vec_id").alias("cell")), "cell", f"{seed}:cell", nlist)
    ids = broadcast_if_small(ids, store="centre-ids")
    return vectors.join(ids, F.col("vec_id") == F.col("cell")).select("cell", "embedding")


def _cell_sums(batches):
    """Sums of unit vectors by cell, one row for each cell that a task has seen."""
    sums = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        cells, parts = _summed(batch.column(0).to_numpy(), unit_rows(batch.column(1)))
        for cell, part in zip(cells.tolist(), parts):
            sums[cell] = sums[cell] + part if cell in sums else part
    if sums:
        yield _sum_rows(list(sums), np.stack(list(sums.values())))


def _summed(cells, x):
    """The cells of some vectors, once each, and the sums of their vectors."""
    order = np.argsort(cells, kind="stable")
    starts = np.flatnonzero(np.diff(cells[order], prepend=cells[order[0]] - 1))
    return cells[order][starts], np.add.reduceat(x[order], starts, axis=0)


def _sum_rows(cells, sums):
    offsets = pa.array(np.arange(len(sums) + 1) * sums.shape[1], pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(cells, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))], names=["cell", "total"])


def _added(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The sum of one cell's sums."""
    total = list_matrix(table["total"]).sum(axis=0)
    return pa.table({"cell": pa.array([key[0].as_py()], pa.int64()), "total": pa.array([total.tolist()], pa.list_(pa.float64()))})


def train_centroids(vectors: DataFrame, nlist: int, seed=SEED, iterations=10, limit=BROADCAST_BYTES) -> DataFrame:
    """Cosine k-means centres (cell, embedding), trained on all vectors.

    It starts from ``nlist`` vectors picked by hash. A round assigns every vector
    to its nearest centre where it lies, adds up unit vectors per cell in each
    task, and the sums of the tasks per cell. A cell without vectors keeps its
    centre. Measured-small centres are held by the driver between the rounds, which
    end when no centre moves any more; beyond that they are a table all along and
    every round's are stored.
    """
    usable = with_vector(vectors).filter(dot(F.col("embedding"), F.col("embedding")) > 0).select("vec_id", "embedding")
    start = sample_centroids(usable, nlist, seed)
    centres = materialize(start.select(F.col("cell").cast("bigint"), F.col("embedding").cast("array<double>")), "centres")
    if fits_broadcast(centres, limit):
        return _train_held(usable, centres, iterations)
    for _ in range(iterations):
        placed = assign_cells(usable, centres, limit).select(F.col("cell").cast("bigint"), "embedding")
        moved = _moved(placed.mapInArrow(_cell_sums, "cell bigint, total array<double>"))
        centres = materialize(
            centres.join(moved, "cell", "left").select("cell", F.coalesce("moved", "embedding").alias("embedding")),
            "centres",
        )
    return centres


def _moved(sums: DataFrame, levels: int = SUM_LEVEL) -> DataFrame:
    """(cell, moved): the directions of the sums of all tasks."""
    if levels > 1:
        # a task's sums meet in levels, so that no cell gathers a row from every task at once
        sums = sums.withColumn("level", F.spark_partition_id() % levels)
        sums = sums.groupBy("cell", "level").applyInArrow(_added, "cell bigint, total array<double>")
    means = sums.groupBy("cell").applyInArrow(_added, "cell bigint, total array<double>")
    # only directions matter; rounding makes them independent of the order of sums
    moved = means.select("cell", l2_normalize(F.col("total")).alias("moved"))
    return moved.withColumn("moved", F.transform("moved", lambda x: F.round(x, DIGITS)))


def _train_held(usable, centres, iterations) -> DataFrame:
    """Rounds of one job each, whose new centres come to the driver."""
    cells, held = _held(centres)
    if not len(cells):
        return centres
    # few tasks send so few rows for a cell that one level adds them up
    levels = SUM_LEVEL if usable.rdd.getNumPartitions() > SUM_LEVEL else 1
    points = usable.select("embedding")
    for _ in range(iterations):
        matrix = unit_matrix(held)

        def sums(batches, matrix=matrix):
            total, seen = np.zeros(matrix.shape), np.zeros(len(matrix), bool)
            for batch in batches:
                if batch.num_rows:
                    x = unit_rows(batch.column(0))
                    places, parts = _summed(_nearest(x, matrix, 1)[:, 0], x)
                    total[places] += parts
                    seen[places] = True
            if seen.any():
                yield _sum_rows(cells[seen], total[seen])

        table = _moved(points.mapInArrow(sums, "cell bigint, total array<double>"), levels).toArrow()
        own, means = table["cell"].to_numpy(), list_matrix(table["moved"])
        order = np.argsort(own)
        place = np.searchsorted(own[order], cells)  # centres that share an id share their mean
        hit = np.isin(cells, own)
        moved = held.copy()
        moved[hit] = means[order[place[hit]]]
        if np.array_equal(moved, held):
            break  # every further round would give the same
        held = moved
    table = pa.Table.from_batches([_sum_rows(cells, held).rename_columns(["cell", "embedding"])])
    return materialize(usable.sparkSession.createDataFrame(table, centres.schema), "centres")


def _held(centroids: DataFrame):
    """Measured-small centres: their cells in order, and their vectors."""
    table = centroids.select(F.col("cell").cast("bigint"), "embedding").toArrow().sort_by("cell")
    return np.asarray(table["cell"].to_numpy(), dtype=np.int64), list_matrix(table["embedding"])


def _nearest(x, matrix, count) -> np.ndarray:
    """The places of the ``count`` nearest centres of each unit row, nearest first.
    Similarities are compared after rounding, equal ones by place."""
    count = min(count, len(matrix))
    narrow = matrix.astype(np.float32).T
    # two similarities further apart in single precision are in the same order in double
    apart = 4 * (matrix.shape[1] + 4) * 2.0**-24 + 2 * 10.0**-DIGITS
    picked = np.zeros((len(x), count), np.int64)
    step = max(1, PRODUCT_CELLS // len(matrix))
    for at in range(0, len(x), step):
        own, out = x[at : at + step], picked[at : at + step]
        if count == 1:
            sims = own.astype(np.float32) @ narrow
            out[:, 0] = sims.argmax(axis=1)
            close = np.count_nonzero(sims >= sims.max(axis=1, keepdims=True) - np.float32(apart), axis=1)
            unsure = np.flatnonzero(close > 1)
            if len(unsure):
                out[unsure, 0] = np.round(own[unsure] @ matrix.T, DIGITS).argmax(axis=1)
            continue
        sims = np.round(own @ matrix.T, DIGITS)
        sims[np.isnan(sims)] = -np.inf
        # stable sorts: equal similarities keep the order of the places
        near = sims >= np.partition(sims, len(matrix) - count, axis=1)[:, len(matrix) - count, None]
        tied = np.count_nonzero(near, axis=1) > count
        places = np.nonzero(near[~tied])[1].reshape(-1, count)
        order = np.argsort(-np.take_along_axis(sims[~tied], places, axis=1), axis=1, kind="stable")
        out[~tied] = np.take_along_axis(places, order, axis=1)
        out[tied] = np.argsort(-sims[tied], axis=1, kind="stable")[:, :count]
    return picked


def nearest_cells(vectors: DataFrame, centroids: DataFrame, count: int = 1, limit=BROADCAST_BYTES) -> DataFrame:
    """Add ``cells``: the ids of the ``count`` nearest centres, nearest first.

    Measured-small centres go into every task and no row moves. Beyond that each vector
    moves once, see ``_nearest_by_tree``; equal similarities go by the cell's id.
    """
    if fits_broadcast(centroids, limit):
        cells, held = _held(centroids)
        count, matrix = min(count, len(cells)), unit_matrix(held)

        def nearest(column: pa.Array) -> pa.Array:
            flat = cells[_nearest(unit_rows(column), matrix, count)].ravel() if len(column) else np.zeros(0, np.int64)
            offsets = np.arange(len(column) + 1, dtype=np.int32) * count
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

        return with_vector(vectors).withColumn("cells", F.arrow_udf(nearest, "array<bigint>")("embedding"))
    return _nearest_by_tree(vectors, centroids, count, limit)


def _angles(x, centres) -> np.ndarray:
    """Angles between unit rows; zero rows are at angle zero to all."""
    angles = np.arccos(np.clip(x @ centres.T, -1.0, 1.0))
    angles[~x.any(axis=1)] = 0.0
    angles[:, ~centres.any(axis=1)] = 0.0
    return angles


def _nearest_by_tree(vectors, centroids, count, limit) -> DataFrame:
    """``nearest_cells`` for more centres than a task can hold; rows (vec_id,
    embedding, cells).

    Some of the centres are coarse ones, few enough for a task. A vector moves once: to
    its nearest coarse centre, where vectors at about the same angle from it make a
    shell, and a shell as many blocks as it needs. If a vector is at angle a of coarse
    centre g, and the ``count`` centres nearest to g are within b of g, its own nearest
    are within 2a + b of g. So a block needs only the centres within that bound of its
    shell's outer edge; a task holds one block and streams them past it.
    """
    usable = with_vector(vectors).select("vec_id", "embedding")
    fine = materialize(
        with_vector(centroids).select(F.col("cell").cast("bigint"), F.col("embedding").cast("array<double>")), "centres")
    first = fine.select(F.size("embedding").alias("d")).first()
    if first is None:
        return usable.limit(0).withColumn("cells", F.array().cast("array<bigint>"))
    total, width = fine.count(), 8 * first["d"] + 32
    count = min(count, total)
    groups = max(1, min(math.isqrt(total), limit // width))
    coarse = materialize(sample_centroids(fine.withColumnRenamed("cell", "vec_id"), groups), "coarse")
    near = exact_topk(fine.withColumnRenamed("cell", "vec_id"), coarse.withColumnRenamed("cell", "qid"), count)
    reach = {r["qid"]: math.acos(max(-1.0, min(1.0, r["sim"]))) for r in near.filter(F.col("rank") == count).collect()}
    table = coarse.toArrow().sort_by("cell")
    matrix = unit_rows(table["embedding"])
    reach = np.array([reach[c] for c in table["cell"].to_pylist()])
    step = math.pi / SHELLS

    def place(column: pa.Array) -> pa.Array:
        x = unit_rows(column)
        sims = x @ matrix.T if len(x) else np.zeros((0, len(matrix)))
        part = sims.argmax(axis=1)
        angle = np.arccos(np.clip(sims[np.arange(len(x)), part], -1.0, 1.0))
        shell = np.minimum((angle / step).astype(np.int64), SHELLS - 1)
        # nothing bounds zero vectors, and those that are nearest to a zero centre
        shell[~x.any(axis=1) | ~matrix[part].any(axis=1)] = SHELLS - 1
        return pa.StructArray.from_arrays([pa.array(part, pa.int32()), pa.array(shell, pa.int32())], names=["part", "shell"])

    def needed(column: pa.Array) -> pa.Array:
        """For each coarse centre the innermost shell that needs a centre."""
        bound = (_angles(unit_rows(column), matrix) - reach[None, :] - 1e-6) / 2
        least = np.clip(np.ceil(bound / step).astype(np.int64) - 1, 0, SHELLS - 1)
        offsets = np.arange(len(least) + 1) * len(matrix)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(least.ravel(), pa.int32()))

    placed = usable.withColumn("_at", F.arrow_udf(place, "struct<part:int,shell:int>")("embedding"))
    placed = placed.select("vec_id", "embedding", "_at.part", "_at.shell")
    rows = max(1, BLOCK_BYTES // width)
    # at most a row for each coarse centre and shell
    sizes = materialize(placed.groupBy("part", "shell").agg(F.ceil(F.count("*") / rows).cast("int").alias("blocks")), "shells")
    held = placed.join(F.broadcast(sizes), ["part", "shell"]).select(
        "part", "shell", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block"), F.lit(0).alias("kind"),
        F.col("vec_id").alias("id"), "embedding", F.lit(None).cast("array<double>").alias("centre"))
    wanted = fine.select("cell", "embedding", F.posexplode(F.arrow_udf(needed, "array<int>")("embedding")).alias("part", "least"))
    wanted = wanted.join(F.broadcast(sizes), "part").filter(F.col("shell") >= F.col("least"))
    streamed = wanted.select(
        "part", "shell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("kind"),
        F.col("cell").alias("id"), F.lit(None).cast(usable.schema["embedding"].dataType).alias("embedding"),
        F.col("embedding").alias("centre"))
    key = ["part", "shell", "block"]
    both = held.unionByName(streamed).repartition(*key).sortWithinPartitions(*key, "kind")
    kinds = T.StructType([
        T.StructField("vec_id", usable.schema["vec_id"].dataType), usable.schema["embedding"],
        T.StructField("cells", T.ArrayType(T.LongType()))])
    return both.mapInArrow(_streamed(count), kinds)


def _streamed(count):
    """Each block's vectors, which come first, against the centres that follow them."""

    def answer(ids, embeddings, best):
        cells = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * count, pa.int32()), pa.array(best.ids.ravel()))
        return pa.RecordBatch.from_arrays([ids, embeddings, cells], names=["vec_id", "embedding", "cells"])

    def run(batches):
        key, ids, embeddings, x, best = None, [], [], None, None

        def close():
            # a block's centres are never none: its coarse centre is one
            return answer(pa.concat_arrays(ids), pa.concat_arrays(embeddings), best)

        for batch in batches:
            marks = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(marks)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                own, kind = tuple(marks[start, :3]), marks[start, 3]
                if own != key:
                    if ids:
                        yield close()
                    key, ids, embeddings, x, best = own, [], [], None, None
                if kind == 0:
                    ids.append(batch.column(4).slice(start, end - start))
                    embeddings.append(batch.column(5).slice(start, end - start))
                    continue
                if x is None:
                    x = unit_rows(pa.concat_arrays(embeddings))
                    best = BestK(np.arange(len(x)), count)
                cells = batch.column(4).slice(start, end - start).to_numpy()
                centres = unit_rows(batch.column(6).slice(start, end - start))
                for at in range(0, len(x), 1024):
                    best.add(x, cells, centres, np.arange(at, min(at + 1024, len(x))))
        if ids:
            yield close()

    return run


def assign_cells(vectors: DataFrame, centroids: DataFrame, limit=BROADCAST_BYTES) -> DataFrame:
    return nearest_cells(vectors, centroids, 1, limit).withColumn("cell", F.col("cells")[0]).drop("cells")


def index_parts(vectors: DataFrame, nlist: int, n: int) -> int:
    """Parts of a stored index: about 64 MB each, never more than cells, so that a
    long list of cells makes no small files."""
    first = vectors.select(F.size("embedding").alias("d")).first()
    size = n * (first["d"] if first else 0) * 4
    return max(1, min(nlist, -(-size // PART_BYTES)))


def cell_parts(centroids: DataFrame, parts: int) -> DataFrame:
    """(cell, part): neighbouring cells share a part. A part is the nearest of
    ``parts`` centres that are picked from the centres themselves, so the cells
    that a query probes lie in few parts."""
    if parts == 1:
        return centroids.select("cell", F.lit(0).cast("bigint").alias("part"))
    own = centroids.select(F.col("cell").alias("vec_id"), "embedding")
    placed = assign_cells(own, materialize(sample_centroids(own, parts), "coarse-centres"))
    return materialize(placed.select(F.col("vec_id").alias("cell"), F.col("cell").alias("part")), "cell-parts")


def with_part(df: DataFrame, places: DataFrame) -> DataFrame:
    """``df`` with the part of its ``cell``."""
    return df.join(broadcast_if_small(places), "cell")


@dataclass(frozen=True)
class IvfIndex:
    """Centres (cell, embedding), the part of each cell (cell, part), and the
    vectors (vec_id, embedding, cell, part) stored by ``part``."""

    centroids: DataFrame
    vectors: DataFrame
    places: DataFrame


def build_ivf(vectors: DataFrame, centroids: DataFrame, parts: int | None = None) -> IvfIndex:
    """Assign every vector to its nearest centre and store it, so that a search
    reads the parts of probed cells."""
    if parts is None:
        parts = index_parts(vectors, centroids.count(), vectors.count())
    places = cell_parts(centroids, parts)
    placed = with_part(assign_cells(vectors.select("vec_id", "embedding"), centroids), places)
    placed = placed.select("vec_id", "embedding", "cell", "part")
    return IvfIndex(centroids, materialize(placed, "ivf", partition_by="part"), places)


def probe_cells(queries: DataFrame, centroids: DataFrame, nprobe: int) -> DataFrame:
    """(qid, rank, cell): the nprobe nearest cells of each query."""
    near = exact_topk(centroids.withColumnRenamed("cell", "vec_id"), queries, nprobe)
    return near.select("qid", "rank", F.col("vec_id").alias("cell"))


def ivf_search(index: IvfIndex, queries, k=TOP_K, nprobe=None, exclude_self=False, limit=BROADCAST_BYTES) -> DataFrame:
    """Top k among the ``nprobe`` nearest cells of each query.

    While queries and probes measure small, only the parts of probed cells are read.
    Beyond that nearly every part is probed by some query, and the index is scanned
    where it lies for each block of queries. It is never shuffled.
    """
    if nprobe is None:
        nprobe = choose_nprobe(index.centroids.count())
    queries = with_vector(queries).select("qid", "embedding")
    pairs = queries.count() * nprobe
    if fits_broadcast(queries, limit) and pairs * PROBE_BYTES <= limit:
        probes = materialize(with_part(probe_cells(queries, index.centroids, nprobe), index.places), "probes")
        return probed_topk(index.vectors, queries, probes, k, exclude_self)
    asked = materialize(probe_floors(queries, index.centroids, nprobe, limit), "probe-floors")
    centres = index.centroids.select("cell", "embedding").join(broadcast_if_small(index.places, limit=limit), "cell")
    return floor_topk(index.vectors, asked, centres, k, exclude_self, limit)
