"""Deleted interpolation over words: the context of a token is the word before it.

    P(w | h) = a(b) c(h, w) / c(h) + b(b) c(w) / N + z(b) / (V + 1)

h is the word before w, or the start of the text. Weights belong to the bucket b of
c(h), its binary logarithm, and are learned as ``lm.learn_weights`` says, from the counts
of each training token without itself. No table of words or pairs has a bound, so none is
held by a task or the driver:

1. texts are put together to chunks of bounded size, a row each, compressed;
2. every chunk asks for the words and pairs that it holds, each once however many
   texts hold it, with its own training counts. A request goes to the part of the key
   space that its keys lie in, where the counts of all chunks are added up;
3. the sums go back to the chunks, in the order of the keys, so that no key is sent
   twice. Each chunk meets its sums once for the weights and once for the scores.

A frequent word or pair is one key of a chunk, like a rare one. Words and pairs are known
by 63-bit hashes. Since each word is followed by one token, c(h) is the count of the word;
that of a text's start is the number of texts, and so that of the end token, whose key it
shares.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import lm
from newsloom.llm.winnow import _mix
from newsloom.session import materialize

CHUNKS_A_PART = 4  # chunks whose requests together make a part of the key space
LEAST_PARTS = 16
CELL_NONE = 1023  # of an estimate that is zero
CODEC = "zstd"

CHUNK = "chunk bigint, doc array<bigint>, learned array<boolean>, length array<bigint>, data binary"
REQUEST = "chunk bigint, part int, keys binary, n binary"
REPLY = "chunk bigint, part int, n binary, words bigint, total bigint"
CELLS = "cell bigint, n bigint"
SCORES = "doc bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def _packed(values):
    """Whole numbers as bytes, those of one place together, with their number in front."""
    places = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(places.tobytes(), CODEC, asbytes=True)


def _unpacked(data):
    size = int.from_bytes(data[:8], "little")
    places = np.frombuffer(pa.decompress(data[8:], size * 8, CODEC, asbytes=True), np.uint8)
    return np.ascontiguousarray(places.reshape(8, size).T).view("<u8").ravel()


def _chunked(batches):
    for rows, texts in lm._groups(batches):
        first = rows.column("row")[0].as_py()
        lists = [[rows.column("doc").to_pylist()], [rows.column("learned").to_pylist()], [[len(t) for t in texts]]]
        kinds = [pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([first]), *[pa.array(v, k) for v, k in zip(lists, kinds)],
             pa.array([pa.compress(b"".join(texts), CODEC, asbytes=True)], pa.binary())],
            names=["chunk", "doc", "learned", "length", "data"])


class _Chunk:
    """The tokens of a chunk's texts by the numbers of their words and pairs."""

    def __init__(self, row):
        lengths = np.array(row["length"], np.int64)
        data = pa.decompress(row["data"], int(lengths.sum()), CODEC, asbytes=True)
        ends = np.cumsum(lengths)
        texts = [data[end - n:end] for end, n in zip(ends.tolist(), lengths.tolist())]
        word, self.text_of = lm.words_of(texts)
        self.doc, self.learned = row["doc"], np.array(row["learned"], bool)
        word |= np.uint64(1)  # the end token is the least key
        self.words, self.word_at = np.unique(word, return_inverse=True)
        before = np.concatenate([[np.uint64(1)], word[:-1]])
        pair = _mix(word + _mix(before) * np.uint64(0x9FB21C651E98DF25)) & ~np.uint64(1)
        self.pairs, first, self.pair_at = np.unique(pair, return_index=True, return_inverse=True)
        self.pair_word = self.word_at[first]
        self.pair_context = np.where(first > 0, self.word_at[first - 1], 0)
        taught = self.learned[self.text_of]
        self.word_n = np.bincount(self.word_at[taught], minlength=len(self.words))
        self.pair_n = np.bincount(self.pair_at[taught], minlength=len(self.pairs))
        # pairs and words in one order of keys, and in parts of the key space
        keys = np.concatenate([self.words, self.pairs])
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def sums(self, replies):
        """Corpus counts: of each pair, of its word and of its context; of each word."""
        said = sorted((r["part"], r["n"]) for r in replies)
        counts = np.empty(len(self.keys), np.int64)
        counts[self.order] = np.concatenate([_unpacked(n) for _, n in said]).astype(np.int64)
        words, pairs = counts[:len(self.words)], counts[len(self.words):]
        return pairs, words[self.pair_word], words[self.pair_context]


def _requests(parts):
    cuts = np.array([-(-(i << 64) // parts) for i in range(1, parts)], np.uint64)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = _Chunk(row)
                n = np.concatenate([chunk.word_n, chunk.pair_n])[chunk.order]
                borders = [0, *np.searchsorted(chunk.keys, cuts).tolist(), len(chunk.keys)]
                rows = [(p, a, b) for p, (a, b) in enumerate(zip(borders, borders[1:])) if a < b]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]] * len(rows), pa.int64()), pa.array([p for p, _, _ in rows], pa.int32()),
                     # sorted keys as steps, which are shorter
                     pa.array([_packed(np.diff(chunk.keys[a:b], prepend=np.uint64(0))) for _, a, b in rows], pa.binary()),
                     pa.array([_packed(n[a:b]) for _, a, b in rows], pa.binary())],
                    names=["chunk", "part", "keys", "n"])

    return run


def _added(table: pa.Table) -> pa.Table:
    """The sums over all chunks of the keys of one part, for each chunk in its own order."""
    chunks, part = table["chunk"].to_pylist(), table["part"][0].as_py()
    keys = [np.cumsum(_unpacked(k.as_py()), dtype=np.uint64) for k in table["keys"]]
    own = np.concatenate([_unpacked(n.as_py()) for n in table["n"]])
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(at, weights=own, minlength=len(distinct)).astype(np.int64)
    borders = np.cumsum([0] + [len(k) for k in keys])
    found = sums[at]
    replies = [_packed(found[a:b]) for a, b in zip(borders, borders[1:])]
    words = sums[(distinct & np.uint64(1)) == 1]
    return pa.table({
        "chunk": pa.array([*chunks, None], pa.int64()), "part": pa.array([part] * (len(chunks) + 1), pa.int32()),
        "n": pa.array([*replies, None], pa.binary()),
        "words": pa.array([None] * len(chunks) + [int((words > 0).sum())], pa.int64()),
        "total": pa.array([None] * len(chunks) + [int(words.sum())], pa.int64()),
    })


def _bucket(context):
    return np.floor(np.log2(np.maximum(context, 1))).astype(np.int64)


def _place(p):
    """The number of a probability's cell, counted from the least."""
    with np.errstate(divide="ignore"):
        cell = np.round(np.log2(p) * lm.STEPS)
    return np.where(np.isfinite(cell), cell + 512, CELL_NONE).astype(np.int64)


def _cells_of(total):
    """Training tokens of a chunk by bucket and by the cells of their deleted estimates."""

    def run(chunks: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = _Chunk(chunks.to_pylist()[0])
        c2, c1, context = chunk.sums(replies.to_pylist())
        seen = chunk.pair_n > 0
        n, c2, c1, context = chunk.pair_n[seen], c2[seen], c1[seen], context[seen]
        two = (c2 - 1) / np.maximum(context - 1, 1)
        one = (c1 - 1) / max(total - 1, 1)
        cells, n = lm._sum_by((_bucket(context) << 20) + (_place(two) << 10) + _place(one), n)
        return pa.table({"cell": pa.array(cells, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


class Model:
    """The sizes and the weights (two, one, zero) of every bucket of context counts."""

    def __init__(self, total, vocabulary, weights):
        self.total, self.vocabulary = total, vocabulary
        self.mix = np.array([weights.get(b, (0.0, 0.0, 1.0)) for b in range(64)])
        # a context that was never seen says nothing: its share goes to the word alone
        zero = weights[max(weights)][2] if weights else 1.0
        self.unseen = np.array([0.0, 1 - zero, zero])

    def base(self, c1):
        return np.log10((c1 + 1) / (self.total + self.vocabulary + 1))

    def score(self, c2, c1, context):
        mix = np.where((context > 0)[:, None], self.mix[_bucket(context)], self.unseen)
        return np.log10(mix[:, 0] * c2 / np.maximum(context, 1) + mix[:, 1] * c1 / max(self.total, 1)
                        + mix[:, 2] / (self.vocabulary + 1))


def _scores_of(model):
    def run(chunks: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = _Chunk(chunks.to_pylist()[0])
        c2, c1, context = chunk.sums(replies.to_pylist())

        def added(values):
            return np.bincount(chunk.text_of, weights=values[chunk.pair_at], minlength=len(chunk.doc))

        return pa.table({
            "doc": pa.array(chunk.doc, pa.int64()), "n_tokens": np.bincount(chunk.text_of, minlength=len(chunk.doc)).astype(np.int64),
            "n_known": added((c1 > 0).astype(float)).astype(np.int64), "base_score": added(model.base(c1)),
            "score": added(model.score(c2, c1, context)),
        })

    return run


def chunks_of(rows: DataFrame) -> DataFrame:
    """Rows (row, doc, learned, text) as stored chunks of texts."""
    return materialize(rows.select("row", "doc", "learned", "text").mapInArrow(_chunked, CHUNK), "chunks")


def replies_to(chunks: DataFrame) -> DataFrame:
    """The corpus counts that each chunk needs, and sizes of the parts in rows without a chunk."""
    parts = max(LEAST_PARTS, chunks.count() // CHUNKS_A_PART)
    requests = chunks.mapInArrow(_requests(parts), REQUEST)
    return materialize(requests.groupBy("part").applyInArrow(_added, REPLY), "replies")


def _meeting(chunks, replies):
    return chunks.groupBy("chunk").cogroup(replies.filter("chunk is not null").groupBy("chunk"))


def learn(chunks: DataFrame, replies: DataFrame) -> Model:
    sizes = replies.filter("chunk is null").agg(F.sum("words").alias("words"), F.sum("total").alias("total")).first()
    total, vocabulary = sizes["total"] or 0, sizes["words"] or 0
    cells = _meeting(chunks, replies).applyInArrow(_cells_of(total), CELLS)
    found = {}
    for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # buckets x cells, whatever the corpus
        places = [r["cell"] >> 10 & 1023, r["cell"] & 1023]
        found[(r["cell"] >> 20, *[None if x == CELL_NONE else x - 512 for x in places])] = r["n"]
    return Model(total, vocabulary, lm.learn_weights(found, vocabulary))


def log_scores(chunks: DataFrame, replies: DataFrame, model: Model) -> DataFrame:
    """(doc, n_tokens, n_known, base_score, score), a row for each text."""
    return _meeting(chunks, replies).applyInArrow(_scores_of(model), SCORES)
