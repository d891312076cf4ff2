"""Alignment of the tokens that two tokenizers give the same text.

Every token ends at a byte of the text. The ends of both tokenizers are two
sorted lists; their intersection is found by galloping: each end of the shorter
list is sought in the longer one from the place of the end before it, by steps
that double and then by binary search. The common ends slice both token lists
into groups that cover the same bytes, and the differences of the ranks of
neighbouring common ends are the ranges of tokens that overlap. Ends of many
texts are placed one after the other and sought at once: every 2^k-th end first,
then those half way between, each from the place of its left neighbour.

A pair of ids is linked in a document if a token of each lies in one group. How
many documents link a pair is counted over the corpus, and a pair is an id's
best if no other pair of that id is linked by more documents. Each document
carries its distinct pairs and how often each occurs, so that texts are encoded
once; pairs are added up in each task before they are shuffled. The table of
pairs goes into every task while it measures small; beyond that it is joined by
pair, with frequent pairs salted.

Tokenizer files are read on the driver and broadcast; their size is checked.

Defined cases: null and empty texts, and texts that either tokenizer doesn't
give back byte for byte, have no tokens: all numbers are zero, the column of
groups is empty. Rows with equal or null ids are documents of their own; an
empty table gives no rows. Further columns of ``align`` stay, but for one of the
name of its result, which is replaced. A document's memory is a few times the
larger of its text and its distinct pairs; other texts are taken in chunks.
"""

import hashlib
import json
from array import array
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from newsloom.llm.bpe import byte_alphabet
from newsloom.session import BROADCAST_BYTES, materialize

FILE_BYTES = 64 << 20  # larger tokenizer files are refused: they would be broadcast
CHUNK_BYTES = 1 << 20  # of text aligned at a time
LARGE = 4096  # links of a group beyond which equal ids of it are counted first
B_BITS = 15  # of a pair (a << B_BITS | b)
PAIR_BYTES = 13  # of a pair, its count and its mark in a task
HOT_ROWS = 100_000  # links of one pair in one task of the join

ALIGNED = "struct<a:array<int>,b:array<int>,groups:array<struct<a_from:int,a_to:int,b_from:int,b_to:int>>>"
MEASURED = (
    "struct<n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string,"
    "pairs:array<int>,times:array<bigint>>"
)
SCORED = "struct<n_best:bigint,count_sum:bigint>"


class Spelled:
    """The bytes of every token of a vocabulary, in one array."""

    def __init__(self, tokens):
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

    def text(self, ids):
        length = self.length[ids]
        ends = np.cumsum(length)
        return self.blob[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[ids] - (ends - length), length)]


class Tokenizers:
    """Both tokenizers of a worker. The ids are those of the public libraries;
    strings of special tokens are plain text."""

    def __init__(self, spec, pattern, model):
        import sentencepiece
        import tiktoken

        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        data = json.loads(spec)
        special = {t["content"] for t in data.get("added_tokens", [])}
        vocabulary = {bytes(byte_of[c] for c in name): i for name, i in data["model"]["vocab"].items() if name not in special}
        # merges have the order of the ids, so the ids serve as ranks
        self.first = tiktoken.Encoding("first", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            names[i] = token
        self.a = Spelled(names)
        self.b = Spelled([self._piece(i) for i in range(self.second.get_piece_size())])
        if len(self.b.length) > 1 << B_BITS or len(names) > 1 << (31 - B_BITS):
            raise ValueError("the vocabularies are too large for pairs of 31 bits")
        self.said_a = [(b"%d," % i, b"%d|" % i) for i in range(len(names))]
        self.said_b = [(b"%d," % i, b"%d;" % i) for i in range(len(self.b.length))]
        self.said = [s for pair in self.said_a + self.said_b for s in pair]

    def _piece(self, i):
        piece = self.second.id_to_piece(i)
        if self.second.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if self.second.is_control(i) or self.second.is_unknown(i):
            return b""
        return piece.replace("▁", " ").encode()

    def encode(self, texts):
        """(ids, ids): what both tokenizers give each text, and nothing for a text
        that is not given back whole."""
        from_a = [array("i", self.first.encode_ordinary(" " + t) if t else []) for t in texts]
        from_b = [array("i", ids) for ids in self.second.encode([t or "" for t in texts], num_threads=1)] if texts else []
        for k, text in enumerate(texts):
            if not (text and self._whole((" " + text).encode(), from_a[k], from_b[k])):
                from_a[k] = from_b[k] = array("i")
        return from_a, from_b

    def _whole(self, text, a, b):
        for table, ids in ((self.a, np.frombuffer(a, np.int32)), (self.b, np.frombuffer(b, np.int32))):
            if not len(ids) or not table.length[ids].all() or table.text(ids).tobytes() != text:
                return False
        return True


def gallop(short, long):
    """(i, j): the places of the values that two rising lists share."""
    n, m = len(short), len(long)
    place = np.zeros(n, np.int64)
    steps = [(np.zeros(min(n, 1), np.int64), np.zeros(min(n, 1), np.int64))]
    stride = 1 << max(0, n - 1).bit_length()
    while stride:
        at = np.arange(stride, n, 2 * stride)
        steps.append((at, at - stride))
        stride >>= 1
    for at, before in steps:
        if len(at):
            place[at] = _seek(short[at], long, place[before], m)
    found = place < m
    found[found] = long[place[found]] == short[found]
    return np.flatnonzero(found), place[found]


def _seek(targets, long, low, m):
    """The first place from ``low`` on with a value that is not below each target."""
    low = low.copy()
    # steps of 1, 2, 4, ... while what is reached is still below the target
    high = low.copy()
    step, live = 1, np.flatnonzero(low < m)
    while len(live):
        live = live[long[high[live]] < targets[live]]
        low[live] = high[live] + 1
        high[live] = np.minimum(high[live] + step, m)
        step *= 2
        live = live[high[live] < m]
    live = np.flatnonzero(low < high)
    while len(live):
        middle = (low[live] + high[live]) >> 1
        below = long[middle] < targets[live]
        low[live[below]] = middle[below] + 1
        high[live[~below]] = middle[~below]
        live = live[low[live] < high[live]]
    return low


class Chunk:
    """Groups of the texts of a chunk, one after the other."""

    def __init__(self, tools, texts):
        from_a, from_b = tools.encode(texts)
        self.n_a, self.n_b = (np.array([len(x) for x in ids], np.int64) for ids in (from_a, from_b))
        self.a, self.b = (np.frombuffer(b"".join(ids), np.int32).astype(np.int64) for ids in (from_a, from_b))
        ends_a, ends_b = np.cumsum(tools.a.length[self.a]), np.cumsum(tools.b.length[self.b])
        if len(ends_a) <= len(ends_b):
            at_a, at_b = gallop(ends_a, ends_b)
        else:
            at_b, at_a = gallop(ends_b, ends_a)
        # both lists of a text end at its end, so no group reaches into the next text
        self.a_to, self.b_to = at_a + 1, at_b + 1
        self.a_from, self.b_from = (np.concatenate([[0], x[:-1]]) if len(x) else x for x in (self.a_to, self.b_to))
        self.size_a, self.size_b = self.a_to - self.a_from, self.b_to - self.b_from
        self.doc = np.repeat(np.arange(len(texts)), self.n_a)[at_a]
        self.n_groups = np.bincount(self.doc, minlength=len(texts))
        self.n_links = self._sums(self.size_a * self.size_b)

    def _sums(self, values):
        """Sums per text of a value of each group."""
        running = np.concatenate([[0], np.cumsum(values)])
        last = np.cumsum(self.n_groups)
        return running[last] - running[last - self.n_groups]

    def groups(self):
        """Slices of both token lists, counted from each text's first token."""
        first_a, first_b = (np.cumsum(n) - n for n in (self.n_a, self.n_b))
        return (
            self.a_from - first_a[self.doc], self.a_to - first_a[self.doc],
            self.b_from - first_b[self.doc], self.b_to - first_b[self.doc],
        )

    def digests(self, tools):
        """The hash of each text's groups, written as ``a1,a2|b1;a3|b2,b3``."""
        said = np.empty(len(self.a) + len(self.b), np.int64)
        last = np.zeros(len(self.a), np.int64)
        last[self.a_to - 1] = 1
        said[np.arange(len(self.a)) + np.repeat(self.b_from, self.size_a)] = 2 * self.a + last
        last = np.zeros(len(self.b), np.int64)
        last[self.b_to - 1] = 1
        said[np.arange(len(self.b)) + np.repeat(self.a_to, self.size_b)] = 2 * (len(tools.said_a) + self.b) + last
        borders = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        out = []
        for start, end in pairwise(borders.tolist()):
            line = b"".join(map(tools.said.__getitem__, said[start:end].tolist()))
            out.append(hashlib.sha256(line[:-1]).hexdigest() if line else "")
        return out

    def pairs(self):
        """(pair, times, texts' first places): each text's distinct pairs, in order."""
        links = self.size_a * self.size_b
        small = np.flatnonzero(links <= LARGE)
        which = np.repeat(small, links[small])
        ends = np.cumsum(links[small])
        at = np.arange(len(which)) - np.repeat(ends - links[small], links[small])
        width = self.size_b[which]
        keys = self._keys(self.doc[which], self.a[self.a_from[which] + at // width], self.b[self.b_from[which] + at % width])
        keys, times = np.unique(keys, return_counts=True)
        more = [(keys, times)]
        for g in np.flatnonzero(links > LARGE).tolist():
            a, count_a = np.unique(self.a[self.a_from[g]:self.a_to[g]], return_counts=True)
            b, count_b = np.unique(self.b[self.b_from[g]:self.b_to[g]], return_counts=True)
            more.append((self._keys(self.doc[g], a[:, None], b[None, :]).ravel(), np.outer(count_a, count_b).ravel()))
        if len(more) > 1:
            keys, times = (np.concatenate(x) for x in zip(*more))
            order = np.argsort(keys, kind="stable")
            keys, times = keys[order], times[order]
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            keys, times = keys[first], np.add.reduceat(times, first)
        places = np.searchsorted(keys, np.arange(len(self.n_a) + 1) << 31)
        return keys & ((1 << 31) - 1), times, places

    @staticmethod
    def _keys(doc, a, b):
        return doc << 31 | a << B_BITS | b


def _lists(values, offsets, kind):
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _struct(arrays, names):
    return pa.StructArray.from_arrays(arrays, names=names)


def _aligned(tools, texts):
    chunk = Chunk(tools, texts)
    slices = _struct([pa.array(x, pa.int32()) for x in chunk.groups()], ["a_from", "a_to", "b_from", "b_to"])
    borders = [np.concatenate([[0], np.cumsum(n)]) for n in (chunk.n_a, chunk.n_b, chunk.n_groups)]
    return _struct([
        _lists(chunk.a, borders[0], pa.int32()), _lists(chunk.b, borders[1], pa.int32()),
        pa.ListArray.from_arrays(pa.array(borders[2], pa.int32()), slices),
    ], ["a", "b", "groups"])


def _measured(tools, texts):
    chunk = Chunk(tools, texts)
    pair, times, places = chunk.pairs()
    counts = [pa.array(x, pa.int64()) for x in (chunk.n_a, chunk.n_b, chunk.n_groups, chunk.n_links)]
    return _struct(
        [*counts, pa.array(chunk.digests(tools), pa.string()), _lists(pair, places, pa.int32()), _lists(times, places, pa.int64())],
        ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
    )


def _chunks(texts):
    """Slices of about CHUNK_BYTES of text."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


_loaded = {}


def _tools(shared):
    if shared.id not in _loaded:
        _loaded.clear()
        _loaded[shared.id] = Tokenizers(*shared.value)
    return _loaded[shared.id]


class Shared:
    """A broadcast with a name that its copies in a worker share."""

    def __init__(self, spark, value):
        self._broadcast = spark.sparkContext.broadcast(value)
        self.id = self._broadcast._jbroadcast.id()

    def __getstate__(self):
        return {"_broadcast": self._broadcast, "id": self.id}

    @property
    def value(self):
        return self._broadcast.value


def share(spark, first, pattern, second) -> Shared:
    """Both tokenizer files, broadcast: a byte-level JSON with the pattern that
    splits its words, and a sentencepiece model."""
    with open(first, encoding="utf-8") as f:
        spec = f.read()
    with open(second, "rb") as f:
        model = f.read()
    if len(spec) + len(model) > FILE_BYTES:
        raise ValueError("the tokenizer files are too large to be broadcast")
    return Shared(spark, (spec, pattern, model))


def public_tokenizers(spark, first="byte_bpe_50k.json", second="piece_bpe_32k.model") -> Shared:
    import public_tokenizers as public

    return share(spark, public.path(first), public.PATTERN, public.path(second))


def _mapped(df, keep, shared, text, name, kind, build) -> DataFrame:
    """The columns ``keep`` and what ``build`` makes of the texts, by chunks."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col(f"`{text}`").alias("text"))
    field = T.StructField(name, T._parse_datatype_string(kind))
    schema = T.StructType([rows.schema["kept"], field])

    def run(batches):
        tools = _tools(shared)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in _chunks(texts):
                kept = batch.column(0).slice(start, end - start)
                yield pa.RecordBatch.from_arrays([kept, build(tools, texts[start:end])], names=["kept", name])

    return rows.mapInArrow(run, schema).select("kept.*", name)


def align(df: DataFrame, shared: Shared, text="text", name="alignment") -> DataFrame:
    """``df`` with both token lists and the slices of them that cover the same bytes."""
    return _mapped(df, [c for c in df.columns if c != name], shared, text, name, ALIGNED, _aligned)


def measure(df: DataFrame, shared: Shared, doc="doc_id", text="text") -> DataFrame:
    """(doc_id, measured): numbers, the hash of the groups, and the distinct pairs."""
    return _mapped(df, [doc], shared, text, "measured", MEASURED, _measured)


def pair_counts(measured: DataFrame) -> DataFrame:
    """(pair, n, best): the documents that link each pair of ids, and whether no
    other pair of its first id has more."""
    counts = measured.select(F.explode("measured.pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    same = Window.partitionBy(F.shiftright("pair", B_BITS))  # at most the second vocabulary
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(same)).alias("best"))


def score(measured: DataFrame, counts: DataFrame, limit=BROADCAST_BYTES) -> DataFrame:
    """``measured`` with (n_best, count_sum) of the links of each document."""
    if counts.count() * PAIR_BYTES <= limit:
        table = counts.toArrow().sort_by("pair")
        shared = Shared(measured.sparkSession, tuple(table[c].to_numpy() for c in ("pair", "n", "best")))

        @F.arrow_udf(SCORED)
        def sums(pairs: pa.Array, times: pa.Array) -> pa.Array:
            known, n, best = shared.value
            at = np.searchsorted(known, pairs.flatten().to_numpy())
            weight = times.flatten().to_numpy()
            border = pairs.offsets.to_numpy() - (pairs.offsets[0].as_py() if len(pairs.offsets) else 0)

            def per_row(values):
                running = np.concatenate([[0], np.cumsum(values)])
                return pa.array(np.diff(running[border]), pa.int64())

            return _struct([per_row(weight * best[at]), per_row(weight * n[at])], ["n_best", "count_sum"])

        return measured.withColumn("scored", sums("measured.pairs", "measured.times"))
    return _joined_score(measured, counts)


def _joined_score(measured, counts) -> DataFrame:
    """The same when the table of pairs outgrows a task. A pair with many links is
    split: its row is repeated, and its links are dealt over the copies. Pairs
    that are split are few by their definition, and so are broadcast."""
    rows = materialize(measured.withColumn("_row", F.monotonically_increasing_id()), "measured-rows")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = max(HOT_ROWS, total // 1_000_000)  # so that at most a million pairs are hot
    counts = counts.withColumn("_parts", (F.col("n") / hot).cast("int") + 1)
    heavy = counts.filter("_parts > 1").select("pair", "_parts")
    links = rows.select("_row", F.explode(F.arrays_zip("measured.pairs", "measured.times")).alias("link"))
    links = links.select("_row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    links = links.join(F.broadcast(heavy), "pair", "left")
    links = links.withColumn("_part", F.pmod(F.xxhash64("_row"), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    dealt = counts.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    sums = links.join(dealt, ["pair", "_part"]).groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    )
    zero = F.lit(0).cast("bigint")
    return rows.join(sums, "_row", "left").withColumn(
        "scored", F.struct(F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"))
    ).drop("_row", "n_best", "count_sum")


def query(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    measured = materialize(measure(docs, public_tokenizers(spark)), "aligned")
    scored = score(measured, materialize(pair_counts(measured), "pair-counts"))
    m = "measured"
    return scored.select(
        "doc_id", f"{m}.n_a", f"{m}.n_b", f"{m}.n_groups", f"{m}.n_links", "scored.n_best", "scored.count_sum",
        f"{m}.groups_sha256",
    )
