"""Near-duplicates by SimHash fingerprints and BK-trees.

A fingerprint is the majority, bit by bit, of the 64-bit hashes of a text's word
shingles. Two fingerprints link if they differ in at most ``RADIUS`` bits, and a
component is what links reach.

Equal fingerprints are one node. Nodes are put into shards: of RADIUS + 1 blocks
of bits, two linked fingerprints agree in one at least, so each node goes to one
shard per block. A shard with very many nodes is split by blocks of its other
bits in the same way. Every shard's nodes are then put into a BK-tree, whose
children are keyed by their distance to the parent, and each new node follows
only the edges within the radius. A tree gives the links that join two of its
parts, at most one less than its nodes; a group of copies never yields all pairs.

Trees are built where their shard lies instead of being broadcast: together
they hold all fingerprints of the corpus, which have no size bound.

Defined cases: null, empty and wordless texts have fingerprint zero and link as
any other; texts of fewer words than a shingle are one shingle; rows with a null
id take part, but a component's id is its least non-null one; repeated rows are
all returned; an empty table gives no rows.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.components import roots
from newsloom.session import broadcast_if_small, materialize

RADIUS = 3
SHINGLE = 3
BLOCK_BITS = 16  # 64 bits in RADIUS + 1 blocks
HOT = 2000  # a shard of more nodes is split; results don't depend on it
SLICE = 1 << 16  # shingles counted at a time


def fingerprint(data: bytes, shingle=SHINGLE) -> int:
    """The fingerprint of UTF-8 bytes, as an unsigned number."""
    import xxhash

    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    hash64 = partial(xxhash.xxh64_intdigest, seed=42)
    places = list(zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(places), SLICE):
        part = places[i:i + SLICE]
        hashes = np.fromiter((hash64(joined[s:e]) for s, e in part), np.uint64, len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(places), bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column) -> Column:
    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        found = [fingerprint((t.as_py() or "").encode()) for t in texts]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return run(text)


class Tree:
    """A BK-tree that keeps which of its nodes are connected."""

    def __init__(self, radius):
        self.radius, self.values, self.children, self.parent = radius, [], [], []

    def _top(self, i):
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def add(self, value):
        """Insert a value; yields one value of each part that it newly joins."""
        new, radius, values, children = len(self.values), self.radius, self.values, self.children
        self.parent.append(new)
        near, seek = [], [0] if values else []
        while seek:
            i = seek.pop()
            d = (values[i] ^ value).bit_count()
            if d <= radius:
                near.append(i)
            seek += [c for edge, c in children[i].items() if d - radius <= edge <= d + radius]
        at = 0 if values else None
        values.append(value)
        children.append({})
        while at is not None:
            d = (values[at] ^ value).bit_count()
            at, below = children[at].get(d), at
            if at is None:
                children[below][d] = new
        for i in near:
            mine, other = self._top(new), self._top(i)
            if mine != other:
                self.parent[max(mine, other)] = min(mine, other)
                yield values[i]


def _tree_links(batches, radius):
    """Links of sorted (path, value, fp) rows, one tree for each (path, value)."""
    shard, tree, held = None, None, None
    for batch in batches:
        path, value, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        a, b = [], []
        for key in zip(path.tolist(), value.tolist(), fp.view(np.uint64).tolist()):
            if key[:2] != shard:
                shard, tree, held = key[:2], None, key[2]  # most shards have one node and no tree
                continue
            if tree is None:
                tree = Tree(radius)
                list(tree.add(held))
            for other in tree.add(key[2]):
                a.append(key[2])
                b.append(other)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], names=["a", "b"]
        )


def _shards(nodes: DataFrame, hot=HOT) -> DataFrame:
    """(path, value, fp): the shards of each fingerprint."""
    mask = (1 << BLOCK_BITS) - 1

    def block(i) -> Column:
        return F.shiftrightunsigned("fp", BLOCK_BITS * i).bitwiseAND(F.lit(mask))

    blocks = range(RADIUS + 1)
    rows = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("path"), block(i).alias("value")) for i in blocks
    ])).alias("s")).select("s.*", "fp")
    large = rows.groupBy("path", "value").agg(F.count("*").alias("n")).filter(F.col("n") > hot)
    large = broadcast_if_small(large.select("path", "value", F.lit(True).alias("large")), store="hot-shards")
    marked = rows.join(large, ["path", "value"], "left")
    # the bits outside the block, in RADIUS + 1 blocks again
    rest_bits = 64 - BLOCK_BITS
    width = rest_bits // (RADIUS + 1)

    def rest(i) -> Column:
        others = [j for j in blocks if j != i]
        return sum((F.shiftleft(block(j), BLOCK_BITS * k) for k, j in enumerate(others[1:], 1)), block(others[0]))

    inner = F.array(*[F.lit(j) for j in blocks])
    outside = F.when(F.col("path") == 0, rest(0))
    for i in blocks[1:]:
        outside = outside.when(F.col("path") == i, rest(i))
    split = marked.filter("large").select("path", "value", "fp", outside.alias("rest"), F.explode(inner).alias("j"))
    part = F.expr(f"shiftrightunsigned(rest, {width} * j) & {(1 << width) - 1}")
    split = split.select(
        (F.col("path") * (RADIUS + 1) + F.col("j") + RADIUS + 1).alias("path"),
        (F.col("value") * (1 << width) + part).alias("value"), "fp",
    )
    return marked.filter("large is null").select("path", "value", "fp").unionByName(split)


def links(nodes: DataFrame, hot=HOT) -> DataFrame:
    """(a, b): links that connect all fingerprints within the radius."""
    rows = _shards(nodes, hot).repartition("path", "value").sortWithinPartitions("path", "value", "fp")
    return rows.mapInArrow(lambda batches: _tree_links(batches, RADIUS), "a bigint, b bigint")


def components(prints: DataFrame, doc="doc_id", hot=HOT) -> DataFrame:
    """(fp, component) of rows with ``doc`` and ``fp``."""
    nodes = materialize(prints.groupBy("fp").agg(F.min(doc).alias("least")), "simhash-nodes")
    linked = materialize(roots(links(nodes.select("fp"), hot)), "simhash-roots")
    least = (
        nodes.join(linked, nodes["fp"] == linked["node"])
        .groupBy("root").agg(F.min("least").alias("component"))
    )
    known = linked.join(least, "root").selectExpr("node", "component")
    joined = nodes.join(known, nodes["fp"] == known["node"], "left")
    return joined.select(
        "fp", F.when(F.col("node").isNotNull(), F.col("component")).otherwise(F.col("least")).alias("component")
    )


def near_duplicates(docs: DataFrame, doc="doc_id", text="text", hot=HOT) -> DataFrame:
    """(doc, fingerprint, component_id) of every row."""
    prints = materialize(docs.select(F.col(doc), fingerprints(F.col(text)).alias("fp")), "simhash-prints")
    found = components(prints, doc, hot)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(found, "fp").select(
        doc, hexed.alias("fingerprint"), F.col("component").alias("component_id")
    )


def keep_one(docs: DataFrame, doc="doc_id", text="text", hot=HOT) -> DataFrame:
    """One row of each component: that of the least id, the first stored on ties.

    Only fingerprints of several rows or with a link are looked up; they and the
    rows to drop are narrow, and are broadcast when they measure small. Texts are
    stored once, so that row numbers stay as they are. A row is kept as a struct,
    so its columns may have any names.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept")
    stored = materialize(
        docs.select(own, fingerprints(F.col(text)).alias("fp"), F.monotonically_increasing_id().alias("row")),
        "simhash-rows",
    )
    of_row = F.col("kept").getField(doc)
    rows = stored.select("fp", "row", F.struct(of_row.isNull().alias("none"), of_row.alias("id"), "row").alias("order"))
    nodes = materialize(rows.groupBy("fp").agg(F.min("order").alias("least"), F.count("*").alias("n")), "simhash-nodes")
    linked = materialize(roots(links(nodes.select("fp"), hot)), "simhash-roots")
    grouped = nodes.join(linked, nodes["fp"] == linked["node"], "left").filter("n > 1 or node is not null")
    grouped = materialize(grouped.select("fp", F.coalesce("root", "fp").alias("group"), "least"), "simhash-groups")
    best = grouped.groupBy("group").agg(F.min("least").alias("best"))
    by_print = broadcast_if_small(
        grouped.join(best, "group").select("fp", F.col("best.row").alias("best")), store="simhash-best")
    dropped = rows.select("fp", "row").join(by_print, "fp").filter("row <> best").select("row")
    dropped = broadcast_if_small(dropped, store="near-copies")
    return stored.join(dropped, "row", "left_anti").select("kept.*")


def query(spark, sf_dir) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
