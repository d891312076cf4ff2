"""Exact and cluster-pruned top-k by cosine similarity.

No query-vector pair ever becomes a row: each task multiplies a block of
vectors with the queries and keeps k rows per query; a window merges them.

Similarities are computed in double precision on unit vectors and compared
after rounding to ``DIGITS`` places, then by id, so the ranking does not depend
on the order in which a processor adds up the products.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.schemas import TOP_K
from newsloom.session import BROADCAST_BYTES, broadcast_if_small, fits_broadcast, materialize, measured_bytes

DIGITS = 9
# unit vectors of one block, in double precision
BLOCK_BYTES = 128 * 1024 * 1024
# similarity values held at a time by one task
PRODUCT_CELLS = 4_000_000
PARTIAL = "qid bigint, vec_id bigint, sim double"
NEIGHBOUR = "qid bigint, rank int, vec_id bigint, sim double"
# candidates of all tasks together, beyond which samples set a floor first
PARTIAL_ROWS = 20_000_000
MOST_TASKS = 10_000
SAMPLED = 64  # one in so many vectors is in the next smaller sample
FLOOR = ["floor_sim", "floor_id"]


def list_matrix(column) -> np.ndarray:
    """Arrow list column of equal lengths to a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def unit_rows(column) -> np.ndarray:
    """The matrix with rows of unit length; zero rows stay zero."""
    return unit_matrix(list_matrix(column))


def unit_matrix(x) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", x, x))
    norms[norms == 0] = 1.0
    return x / norms[:, None]


class BestK:
    """Running top k per query over blocks of vectors. With ``floors``, a
    similarity and an id per query, only what ranks before them is kept."""

    def __init__(self, qids, k, floors=None):
        self.qids, self.k = qids, k
        self.floors = floors or (np.full(len(qids), -np.inf), np.full(len(qids), np.iinfo(np.int64).max))
        self.sim, self.ids = (np.repeat(f[:, None], k, axis=1) for f in self.floors)

    def add(self, queries, ids, vectors, rows, exclude_self=False):
        """Offer ``vectors`` to the queries at ``rows`` of the query matrix."""
        step = max(1, PRODUCT_CELLS // max(1, len(rows)))
        for at in range(0, len(ids), step):
            part = ids[at : at + step]
            sims = np.round(queries[rows] @ vectors[at : at + step].T, DIGITS)
            if exclude_self:
                sims[self.qids[rows][:, None] == part[None, :]] = -np.inf
            self._merge(rows, part, sims)

    def _merge(self, rows, ids, sims):
        k = self.k
        floor = self.sim[rows, -1]
        if sims.shape[1] > k:
            kth = np.partition(sims, sims.shape[1] - k, axis=1)[:, -k]
            floor = np.maximum(floor, kth)
        # ties with the floor stay in: the id decides between them below
        r, c = np.nonzero((sims >= floor[:, None]) & (sims > -np.inf))
        touched = np.unique(r)
        if not len(touched):
            return
        old_sim, old_ids = self.sim[rows[touched]], self.ids[rows[touched]]
        who = np.concatenate([r, np.repeat(touched, k)])
        sim = np.concatenate([sims[r, c], old_sim.ravel()])
        vec = np.concatenate([ids[c], old_ids.ravel()])
        order = np.lexsort((vec, -sim, who))
        who, sim, vec = who[order], sim[order], vec[order]
        starts = np.searchsorted(who, touched)
        rank = np.arange(len(who)) - np.repeat(starts, np.diff(np.append(starts, len(who))))
        keep = rank < k
        self.sim[rows[touched]] = sim[keep].reshape(-1, k)
        self.ids[rows[touched]] = vec[keep].reshape(-1, k)

    def columns(self):
        floor, last = (f[:, None] for f in self.floors)
        filled = (self.sim > floor) | ((self.sim == floor) & (self.ids < last))
        qids = np.repeat(self.qids, filled.sum(axis=1))
        return {"qid": qids, "vec_id": self.ids[filled], "sim": self.sim[filled]}


def _ids(column) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False), dtype=np.int64)


def _gather(queries: DataFrame):
    """Measured-small queries as (ids, unit matrix, floors or None)."""
    floor = [F.col(c) for c in FLOOR if c in queries.columns]
    table = queries.select(F.col("qid").cast("bigint"), "embedding", *floor).toArrow().sort_by("qid")
    floors = None
    if floor:
        floors = (
            np.array(table["floor_sim"].fill_null(-np.inf).to_numpy(), dtype=np.float64),
            np.array(table["floor_id"].fill_null(np.iinfo(np.int64).max).to_numpy(), dtype=np.int64),
        )
    return np.asarray(table["qid"].to_numpy(), dtype=np.int64), unit_rows(table["embedding"]), floors


def with_vector(df: DataFrame) -> DataFrame:
    return df.filter(F.col("embedding").isNotNull())


def merge_topk(partial: DataFrame, k: int) -> DataFrame:
    """Final ranking of candidate rows; each task keeps k per query first."""
    by = Window.partitionBy("qid").orderBy(F.desc("sim"), "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(by))
        .filter(F.col("rank") <= k)
        .select("qid", "rank", "vec_id", "sim")
    )


def _scan(vectors: DataFrame, queries: DataFrame, k: int, probes=None, exclude_self=False):
    """Map-only candidates: every task holds the query matrix."""
    qids, matrix, floors = _gather(queries)
    rows_of = None
    if probes is not None:
        pairs = probes.select("qid", "cell").toArrow()
        at = np.searchsorted(qids, _ids(pairs["qid"]))
        rows_of = {}
        for row, cell in zip(at.tolist(), pairs["cell"].to_pylist()):
            rows_of.setdefault(cell, []).append(row)
        rows_of = {cell: np.array(sorted(rows)) for cell, rows in rows_of.items()}
    everyone = np.arange(len(qids))

    def run(batches):
        best = BestK(qids, k, floors)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, vectors = _ids(batch.column(0)), unit_rows(batch.column(1))
            if rows_of is None:
                best.add(matrix, ids, vectors, everyone, exclude_self)
                continue
            cells = _ids(batch.column(2))
            for cell in np.unique(cells).tolist():
                here = cells == cell
                if cell in rows_of:
                    best.add(matrix, ids[here], vectors[here], rows_of[cell], exclude_self)
        yield pa.RecordBatch.from_pydict(best.columns())

    columns = [F.col("vec_id").cast("bigint"), "embedding"]
    if probes is not None:
        columns.append(F.col("cell").cast("bigint"))
    if not len(qids):
        return vectors.sparkSession.createDataFrame([], PARTIAL)
    return with_vector(vectors).select(*columns).mapInArrow(run, PARTIAL)


def block_candidates(vectors: DataFrame, queries: DataFrame, k: int, exclude_self=False, block_rows=None):
    """Candidates when the queries are too many for one task.

    Both sides carry a cell. Rows of a cell are salted into blocks of about
    ``block_rows`` (128 MB by default) by a hash of their id, and each pair of
    blocks is one group, so a hot cell is spread over many bounded groups.
    """
    if block_rows is None:
        first = vectors.select(F.size("embedding").alias("d")).first()
        block_rows = max(1, BLOCK_BYTES // (8 * max(1, first["d"] if first else 1)))

    def blocks(df, name):
        return df.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias(name))

    plan = broadcast_if_small(blocks(vectors, "_nv").join(blocks(queries, "_nq"), "cell"))

    def salted(df, key, own, other, mine, theirs):
        return (
            df.join(plan, "cell")
            .withColumn(mine, F.pmod(F.xxhash64(key), F.col(own)).cast("int"))
            .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            # renewed columns: both sides may come from one table
            .select(*[F.col(c).cast("bigint").alias(c) for c in ("cell", "_bv", "_bq", key)],
                    F.col("embedding").alias("embedding"))
        )

    left = salted(vectors, "vec_id", "_nv", "_nq", "_bv", "_bq")
    right = salted(queries, "qid", "_nq", "_nv", "_bq", "_bv")

    def run(vector_block: pa.Table, query_block: pa.Table) -> pa.Table:
        best = BestK(_ids(query_block["qid"].combine_chunks()), k)
        if vector_block.num_rows and query_block.num_rows:
            ids, x = _ids(vector_block["vec_id"].combine_chunks()), unit_rows(vector_block["embedding"])
            q = unit_rows(query_block["embedding"])
            for at in range(0, len(q), 1024):
                rows = np.arange(at, min(at + 1024, len(q)))
                best.add(q, ids, x, rows, exclude_self)
        return pa.table(best.columns())

    keys = ["cell", "_bv", "_bq"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, PARTIAL)


def _floors(top: DataFrame, k: int) -> DataFrame:
    """The last of k neighbours of each query that has as many."""
    return top.filter(F.col("rank") == k).select("qid", F.col("sim").alias("floor_sim"), F.col("vec_id").alias("floor_id"))


def levelled(vectors: DataFrame, queries: DataFrame, k: int, scan, rows=None) -> DataFrame:
    """Candidates of ``scan(vectors, queries)``, few however many tasks there are.

    Each task keeps k rows for each query, so all together send tasks x queries x k.
    Where that is too much, the k-th neighbour within a sample of the vectors bounds
    the answer from below: it joins the candidates itself, and tasks send only what
    ranks before it, about k x SAMPLED rows for each query over all tasks. A sample
    that is still too large is searched in the same way by a smaller one.
    """
    rows = PARTIAL_ROWS if rows is None else rows
    n = queries.count()
    samples = [vectors]
    # planning tells the number of tasks, and is spared where no number would be too much
    while n * k * MOST_TASKS > rows and samples[-1].rdd.getNumPartitions() * n * k > rows and len(samples) < 6:
        mark = F.pmod(F.xxhash64("vec_id", F.lit(len(samples))), F.lit(SAMPLED)) == 0
        samples.append(materialize(samples[-1].filter(mark), "sample"))
    asked, floors = queries, None
    for sample in reversed(samples):
        found = scan(sample, asked)
        if floors is not None:
            found = found.unionByName(floors.select("qid", F.col("floor_id").alias("vec_id"), F.col("floor_sim").alias("sim")))
        if sample is samples[0]:
            return found
        floors = materialize(_floors(merge_topk(found, k), k), "floors")
        asked = queries.join(broadcast_if_small(floors), "qid", "left")


def query_blocks(queries: DataFrame, limit: int):
    """The queries in blocks that measure under the limit. Write them first: each
    block reads them again."""
    count = -(-measured_bytes(queries) * 5 // (4 * max(limit, 1))) if limit > 0 else 1
    if count <= 1:
        return [queries]
    return [queries.filter(F.pmod(F.xxhash64("qid"), F.lit(count)) == b) for b in range(count)]


def _united(parts):
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def exact_topk(
    vectors: DataFrame, queries: DataFrame, k=TOP_K, exclude_self=False, limit=BROADCAST_BYTES, rows=None,
) -> DataFrame:
    """The k most similar vectors of each query: (qid, rank, vec_id, sim).

    Queries that measure small go into every task and the vectors are scanned
    once. More queries than that come in blocks, with a scan each; the vectors are
    never shuffled.
    """
    queries = with_vector(queries).select("qid", "embedding")

    def scan(some, asked):
        return _scan(some, asked, k, None, exclude_self)

    if fits_broadcast(queries, limit):
        return merge_topk(levelled(vectors, queries, k, scan, rows), k)
    blocks = query_blocks(materialize(queries, "queries"), limit)
    return _united([
        materialize(merge_topk(levelled(vectors, block, k, scan, rows), k), "found") for block in blocks
    ])


def _probed(indexed: DataFrame, probes: DataFrame) -> DataFrame:
    """Rows of probed cells; a stored index is pruned to their partitions."""
    if "part" not in indexed.columns:
        return indexed.join(F.broadcast(probes.select("cell").distinct()), "cell", "left_semi")
    # always true: Spark prunes partitions by a join only if that side is filtered
    wanted = probes.select("part", "cell").distinct().filter("part >= 0")
    return indexed.join(F.broadcast(wanted), ["part", "cell"], "left_semi")


def probed_topk(
    indexed: DataFrame, queries: DataFrame, probes: DataFrame, k=TOP_K, exclude_self=False, rows=None,
) -> DataFrame:
    """Top k among the vectors of the probed cells of each query, for measured-small
    queries and probes.

    ``indexed`` is (vec_id, embedding, cell) and ``probes`` (qid, cell), both
    with a ``part`` when the index is stored: only the parts of probed cells are
    read. Rows are scanned where they lie, so a hot cell is as many tasks as it
    has files.
    """
    queries = with_vector(queries).select("qid", "embedding")

    def scan(some, asked):
        return _scan(_probed(some, probes), asked, k, probes, exclude_self)

    return merge_topk(levelled(indexed, queries, k, scan, rows), k)


def centre_blocks(centres: DataFrame, limit: int, key="cell"):
    """(condition on ``key``, gathered centres) of blocks that measure under the limit."""
    count = max(1, -(-measured_bytes(centres) * 5 // (4 * limit))) if limit > 0 else 1
    for b in range(count):
        own = F.pmod(F.xxhash64(key), F.lit(count)) == b if count > 1 else F.lit(True)
        table = centres.filter(own).select(F.col("cell").cast("bigint"), "embedding").toArrow().sort_by("cell")
        if len(table):
            yield own, np.asarray(table["cell"].to_numpy(), dtype=np.int64), unit_rows(table["embedding"])


def _nearest_centres(cells, matrix, keep):
    """The ``keep`` nearest of a block of centres, nearest first."""

    def nearest(column: pa.Array) -> pa.Array:
        sims, picked = [np.zeros(0)], [np.zeros(0, np.int64)]
        x = unit_rows(column)
        step = max(1, PRODUCT_CELLS // max(1, len(cells)))
        for at in range(0, len(x), step):
            own = np.round(x[at:at + step] @ matrix.T, DIGITS)
            # stable: equal similarities keep the order of the cell ids
            order = np.argsort(-own, axis=1, kind="stable")[:, :keep]
            sims.append(np.take_along_axis(own, order, axis=1).ravel())
            picked.append(cells[order].ravel())
        flat = pa.StructArray.from_arrays([pa.array(np.concatenate(c)) for c in (sims, picked)], names=["sim", "cell"])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * keep, pa.int32()), flat)

    return nearest


def probe_floors(queries: DataFrame, centres: DataFrame, nprobe: int, limit=BROADCAST_BYTES) -> DataFrame:
    """(qid, embedding, probe_sim, probe_cell): the last of the ``nprobe`` nearest
    centres of each query. The cells that rank up to it are those it probes, so a list
    of probes, which grows with the cells, is never written.

    Queries are scanned where they lie, once for each block of centres.
    """
    ranked = None
    for _, cells, matrix in centre_blocks(centres, limit):
        nearest = _nearest_centres(cells, matrix, min(nprobe, len(cells)))
        near = F.arrow_udf(nearest, "array<struct<sim:double,cell:bigint>>")("embedding")
        block = queries.select("qid", "embedding", near.alias("near"))
        ranked = block if ranked is None else ranked.unionByName(block)
    # one row for each block of centres meets per query
    if ranked is None:
        return queries.select("qid", "embedding", F.lit(None).cast("double").alias("probe_sim"), F.lit(None).cast("bigint").alias("probe_cell"))
    merged = ranked.groupBy("qid").agg(
        F.any_value("embedding").alias("embedding"), F.flatten(F.collect_list("near")).alias("near"))
    order = F.array_sort(F.transform("near", lambda n: F.struct((-n["sim"]).alias("far"), n["cell"].alias("cell"))))
    last = F.get(order, F.least(F.lit(nprobe), F.size("near")) - 1)
    return merged.select("qid", "embedding", last.alias("last")).select(
        "qid", "embedding", (-F.col("last.far")).alias("probe_sim"), F.col("last.cell").alias("probe_cell"))


def floor_topk(
    indexed: DataFrame, queries: DataFrame, centres: DataFrame, k=TOP_K, exclude_self=False, limit=BROADCAST_BYTES, rows=None,
) -> DataFrame:
    """Top k among the probed cells, for any number of queries, cells and probes.

    ``queries`` come from ``probe_floors``, and ``centres`` have the ``part`` of each
    cell if the index is stored by it. Tasks scan the index where it lies; which
    queries probe a cell follows from its centre and the queries' last probe. Queries
    come in blocks; if the centres are too many for a task, so do they, each block with
    its own parts of the index, so that each part is read once for a block of queries.
    """
    key = "part" if "part" in indexed.columns else "cell"
    found = []
    for block in query_blocks(queries, limit):
        for own, cells, matrix in centre_blocks(centres, limit, key):
            def scan(some, asked, cells=cells, matrix=matrix):
                return _floor_scan(some, asked, cells, matrix, k, exclude_self)

            candidates = levelled(indexed.filter(own), block, k, scan, rows)
            found.append(materialize(merge_topk(candidates, k).drop("rank"), "found"))
    return merge_topk(_united(found), k) if found else queries.sparkSession.createDataFrame([], NEIGHBOUR)


def _floor_scan(indexed, queries, cells, matrix, k, exclude_self):
    """Candidates of the queries in the cells that their floors admit."""
    qids, asked, floors = _gather(queries)
    if not len(qids):
        return indexed.sparkSession.createDataFrame([], PARTIAL)
    last = queries.select(F.col("qid").cast("bigint"), "probe_sim", "probe_cell").toArrow().sort_by("qid")
    probe_sim, probe_cell = last["probe_sim"].to_numpy(), last["probe_cell"].to_numpy()

    def probing(cell):
        sims = np.round(asked @ matrix[np.searchsorted(cells, cell)], DIGITS)
        return np.flatnonzero((sims > probe_sim) | ((sims == probe_sim) & (cell <= probe_cell)))

    def run(batches):
        best, rows_of = BestK(qids, k, floors), {}
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, vectors, own = _ids(batch.column(0)), unit_rows(batch.column(1)), _ids(batch.column(2))
            for cell in np.unique(own).tolist():
                if cell not in rows_of:
                    rows_of[cell] = probing(cell)
                if len(rows_of[cell]):
                    here = own == cell
                    best.add(asked, ids[here], vectors[here], rows_of[cell], exclude_self)
        yield pa.RecordBatch.from_pydict(best.columns())

    columns = [F.col("vec_id").cast("bigint"), "embedding", F.col("cell").cast("bigint")]
    return with_vector(indexed).select(*columns).mapInArrow(run, PARTIAL)
