"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of orders two, one and zero:

    P(w | h) = a(b) c(h, w) / c(h) + b(b) c(w) / N + z(b) / (V + 1)

In ``score_texts``, and so in the query, a context h is the word before (see
``word_lm``). ``learn`` and ``log_scores`` hold the model with contexts of a bounded
number, which no query uses: there h is the class of the word before (a hash into
``CLASSES`` classes, so that the table of contexts has a fixed size). The weights belong to the bucket b
of the context's frequency, its binary logarithm, and are learned by expectation
maximisation on deleted counts: every training token is predicted from the
counts without itself, so all of the corpus serves as held-out data.

With classes, work is split by word. The most frequent words of a small sample, and the end
token, are looked up in a table of HOT x CLASSES counts, broadcast and bounded by
these parameters; they carry half of all tokens and never enter a shuffle. Which
words these are changes the work and not the result. All other words are counted
and scored where their rows meet; each has a tiny share of all rows.
Words are known by their 64-bit hashes.

Defined cases: a null or empty text is the end token alone; null ids are held in;
repeated rows count, and are scored, each on its own; without training texts the
model is uniform over the one unknown token and every score is 0; an empty table
gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.llm.winnow import byte_class_hashes

CLASSES = 1 << 10
HOT = 512
HOT_SAMPLE = 0.02  # share of the rows that the frequent words are taken from
FOLDS, HELD_OUT = 7, 2
GROUP_BYTES = 8 << 20  # text a task handles together
STEPS = 4  # cells per binary logarithm of a probability, when weights are learned
ROUNDS = 60
LEAST_WEIGHT = 1e-6
END, START = np.uint64(0), np.uint64(1)  # hashes of words are never below 2

_byte = np.arange(256)
IS_WORD = ~((_byte == 32) | ((_byte >= 9) & (_byte <= 13)))


def is_held_out(doc: Column, folds=FOLDS, fold=HELD_OUT) -> Column:
    return F.crc32(F.coalesce(doc.cast("string"), F.lit(""))) % folds == fold


def words_of(texts):
    """(word, number of the text) of every token of a list of bytes, end tokens
    included, in order."""
    hashes, starts, _ = byte_class_hashes(b"\n".join(texts), IS_WORD)
    hashes = np.maximum(hashes, np.uint64(2))
    borders = np.cumsum([len(t) + 1 for t in texts])
    text_of = np.searchsorted(borders, starts, "right")
    n = len(texts)
    counts = np.bincount(text_of, minlength=n)
    ends = np.cumsum(counts + 1) - 1  # places of the end tokens
    word = np.zeros(len(hashes) + n, np.uint64)
    place = np.arange(len(hashes)) + text_of
    word[place] = hashes
    word[ends] = END
    return word, np.repeat(np.arange(n), counts + 1)


def _tokens(texts):
    """(word, class of the word before, number of the text) of every token of a
    list of bytes, end tokens included, in order."""
    word, text_of = words_of(texts)
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[0] = START
    before[1:][word[:-1] == END] = START
    mixed = (before ^ (before >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    cls = (mixed >> np.uint64(64 - CLASSES.bit_length() + 1)).astype(np.int64)
    return word, cls, text_of


def _groups(batches):
    """Slices of the batches of bounded size, each with its texts as bytes."""
    for batch in batches:
        texts = [(t.as_py() or "").encode() for t in batch.column("text")]
        at = 0
        while at < len(texts):
            size, upto = 0, at
            while upto < len(texts) and (upto == at or size + len(texts[upto]) <= GROUP_BYTES):
                size += len(texts[upto])
                upto += 1
            yield batch.slice(at, upto - at), texts[at:upto]
            at = upto


def _column(rows, name):
    return rows.column(name).to_numpy(zero_copy_only=False)


def _hot_places(word, hot):
    """The place of each word among the sorted hot ones, or -1."""
    at = np.minimum(np.searchsorted(hot, word), len(hot) - 1)
    return np.where(hot[at] == word, at, -1)


def _sum_by(keys, weights):
    """Distinct keys and the sums of their weights."""
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(place, weights=weights, minlength=len(distinct)).astype(np.int64)


def _sample_words(batches):
    for _, texts in _groups(batches):
        words, n = np.unique(_tokens(texts)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["w", "n"])


def hot_words(docs: DataFrame) -> np.ndarray:
    """Hashes of frequent words, sorted: at most HOT and the end token."""
    counts = docs.select("text").sample(HOT_SAMPLE, seed=1).mapInArrow(_sample_words, "w bigint, n bigint")
    top = counts.groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(HOT).collect()
    return np.unique(np.array([0] + [r["w"] for r in top], np.int64).view(np.uint64))


class Counts:
    """The bounded tables: all tokens, contexts by class, hot words by class."""

    def __init__(self, hot, table):
        self.hot = hot
        self.by_class = table  # (hot words + 1) x CLASSES; the last row is every other word
        self.contexts = table.sum(axis=0)
        self.words = table[:-1].sum(axis=1)
        self.total = int(table.sum())


def _task_counts(hot):
    def run(batches):
        table = np.zeros((len(hot) + 1) * CLASSES, np.int64)
        for rows, texts in _groups(batches):
            word, cls, text_of = _tokens(texts)
            learned = _column(rows, "learned")[text_of]
            place = _hot_places(word[learned], hot) % (len(hot) + 1)
            table += np.bincount(place * CLASSES + cls[learned], minlength=len(table))
        cells = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(table[cells])], names=["cell", "n"])

    return run


def bounded_counts(rows: DataFrame, hot) -> Counts:
    parts = rows.select("learned", "text").mapInArrow(_task_counts(hot), "cell bigint, n bigint")
    sums = parts.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # HOT x CLASSES rows at most
    table = np.zeros((len(hot) + 1) * CLASSES, np.int64)
    table[sums["cell"].to_numpy()] = sums["n"].to_numpy()
    return Counts(hot, table.reshape(-1, CLASSES))


def _task_pairs(hot):
    """(w, g, n): training counts of a word after a class, for words that are not hot."""

    def run(batches):
        for rows, texts in _groups(batches):
            word, cls, text_of = _tokens(texts)
            kept = _column(rows, "learned")[text_of] & (_hot_places(word, hot) < 0)
            words, place = np.unique(word[kept], return_inverse=True)
            keys, n = np.unique(place * CLASSES + cls[kept], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[keys // CLASSES].view(np.int64)), pa.array((keys % CLASSES).astype(np.int32)),
                 pa.array(n.astype(np.int64))],
                names=["w", "g", "n"],
            )

    return run


def _cell(p):
    """The number of a probability's cell, as an expression; null for zero."""
    return F.round(F.log2(F.when(p > 0, p)) * STEPS).cast("int")


def bucket(context_count):
    return F.floor(F.log2(F.greatest(context_count, F.lit(1)))).cast("int")


def _context_table(spark, contexts):
    return F.broadcast(spark.createDataFrame(
        [(g, int(n)) for g, n in enumerate(contexts)], "g int, context bigint"))


def histogram(rows: DataFrame, counts: Counts):
    """Training tokens by bucket and by the cells of their deleted estimates of
    orders two and one: (bucket, two, one, n), a bounded table; and the number
    of words that are not hot."""
    spark = rows.sparkSession
    pairs = rows.select("learned", "text").mapInArrow(_task_pairs(counts.hot), "w bigint, g int, n bigint")
    pairs = pairs.repartition("w").groupBy("w", "g").agg(F.sum("n").alias("c2"))
    pairs = pairs.withColumn("c1", F.sum("c2").over(Window.partitionBy("w")))
    joined = pairs.join(_context_table(spark, counts.contexts), "g")
    two = F.when(F.col("context") > 1, (F.col("c2") - 1) / (F.col("context") - 1)).otherwise(F.lit(0.0))
    one = (F.col("c1") - 1) / F.lit(float(max(counts.total - 1, 1)))
    cells = joined.select(
        bucket(F.col("context")).alias("bucket"), _cell(two).alias("two"), _cell(one).alias("one"), "c2", "c1"
    ).groupBy("bucket", "two", "one").agg(
        F.sum("c2").alias("n"), F.sum(F.col("c2") / F.col("c1")).alias("words")
    ).collect()  # buckets x cells, whatever the corpus
    found = {(r["bucket"], r["two"], r["one"]): r["n"] for r in cells}
    rare = round(sum(r["words"] for r in cells))
    i, g = np.nonzero(counts.by_class[:-1])
    c2, context, c1 = counts.by_class[i, g], counts.contexts[g], counts.words[i]
    with np.errstate(divide="ignore", invalid="ignore"):
        cell = [np.round(np.log2(p) * STEPS) for p in ((c2 - 1) / (context - 1), (c1 - 1) / max(counts.total - 1, 1))]
    buckets = np.floor(np.log2(np.maximum(context, 1))).astype(int)
    for b, x2, x1, n in zip(buckets.tolist(), *(c.tolist() for c in cell), c2.tolist()):
        key = (b, *(int(x) if np.isfinite(x) else None for x in (x2, x1)))
        found[key] = found.get(key, 0) + n
    return found, rare


def learn_weights(found, vocabulary):
    """The weights (two, one, zero) of every bucket, by expectation maximisation."""
    weights = {}
    for b in {key[0] for key in found}:
        own = [(two, one, n) for (k, two, one), n in found.items() if k == b]
        p = np.array([[0.0 if x is None else 2.0 ** (x / STEPS) for x in cells[:2]] + [1 / (vocabulary + 1)]
                      for cells in own])
        n = np.array([cells[2] for cells in own], float)
        mix = np.full(3, 1 / 3)
        for _ in range(ROUNDS):
            share = p * mix
            share /= share.sum(axis=1, keepdims=True)
            mix = np.maximum((share * n[:, None]).sum(axis=0) / n.sum(), LEAST_WEIGHT)
            mix /= mix.sum()
        weights[b] = mix
    return weights


class Model:
    """What scoring needs: the bounded counts, the weights by class, the sizes."""

    def __init__(self, counts, vocabulary, weights):
        self.counts, self.vocabulary = counts, vocabulary
        buckets = np.floor(np.log2(np.maximum(counts.contexts, 1))).astype(int)
        self.mix = np.array([weights.get(b, (0.0, 0.0, 1.0)) for b in buckets.tolist()])
        # a class that was never seen says nothing: its share goes to the word alone
        unseen = counts.contexts == 0
        known = weights[max(weights)] if weights else np.array([0.0, 0.0, 1.0])
        self.mix[unseen] = [0.0, 1 - known[2], known[2]]

    def base(self, c):
        """log10 of the add-one estimate for a count."""
        return np.log10((c + 1) / (self.counts.total + self.vocabulary + 1))

    def hot_scores(self, place, cls):
        counts, mix = self.counts, self.mix[cls]
        c1 = counts.words[place]
        two = counts.by_class[place, cls] / np.maximum(counts.contexts[cls], 1)
        one = c1 / max(counts.total, 1)
        return self.base(c1), np.log10(mix[:, 0] * two + mix[:, 1] * one + mix[:, 2] / (self.vocabulary + 1)), c1 > 0


def learn(rows: DataFrame) -> Model:
    """Learn from the rows (learned, text) whose flag is set."""
    hot = hot_words(rows)
    counts = bounded_counts(rows, hot)
    found, rare = histogram(rows, counts)
    vocabulary = rare + int((counts.words > 0).sum())
    return Model(counts, vocabulary, learn_weights(found, vocabulary))


def _task_entries(shared):
    """For each text one row with its sums over hot words (``text`` filled), and a
    row for each of its other (word, class) pairs."""

    def run(batches):
        model = shared.value
        hot = model.counts.hot
        for rows, texts in _groups(batches):
            word, cls, text_of = _tokens(texts)
            n = len(texts)
            place = _hot_places(word, hot)
            is_hot = place >= 0
            base, score, known = model.hot_scores(place[is_hot], cls[is_hot])
            at = text_of[is_hot]
            sums = pa.StructArray.from_arrays(
                [pa.array(np.bincount(text_of, minlength=n).astype(np.int64)),
                 pa.array(np.bincount(at, weights=known, minlength=n).astype(np.int64)),
                 pa.array(np.bincount(at, weights=base, minlength=n)),
                 pa.array(np.bincount(at, weights=score, minlength=n))],
                ["tokens", "known", "base", "score"],
            )
            # summary rows are spread over the words' partitions by their row number
            yield pa.RecordBatch.from_arrays(
                [rows.column("row"), rows.column("row"), pa.nulls(n, pa.int64()), rows.column("doc"), sums],
                names=["row", "w", "pair", "doc", "sums"],
            )
            words, at = np.unique(word[~is_hot], return_inverse=True)
            text, cls = text_of[~is_hot], cls[~is_hot]
            order = np.lexsort((cls, at, text))
            at, text, cls = at[order], text[order], cls[order]
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | (cls[1:] != cls[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.concatenate([first, [len(at)]]))
            at, text, cls = at[first], text[first], cls[first]
            pair = (times * 2 + _column(rows, "learned")[text]) * CLASSES + cls
            for i in range(0, len(at), 1 << 18):
                part = slice(i, i + (1 << 18))
                size = len(at[part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_column(rows, "row")[text[part]]), pa.array(words[at[part]].view(np.int64)),
                     pa.array(pair[part]), pa.nulls(size, pa.int64()), pa.nulls(size, sums.type)],
                    names=["row", "w", "pair", "doc", "sums"],
                )

    return run


ENTRY = "row bigint, w bigint, pair bigint, doc bigint, sums struct<tokens:bigint,known:bigint,base:double,score:double>"


def log_scores(rows: DataFrame, model: Model) -> DataFrame:
    """(row, doc, n_tokens, n_known, base_score, score) of rows (row, doc, learned, text).

    One shuffle brings the rows of a word together, where windows count it; the
    next adds up the sums of a document, which tasks add up first.
    """
    spark = rows.sparkSession
    counts, size = model.counts, model.vocabulary + 1
    shared = spark.sparkContext.broadcast(model)
    entries = rows.select("row", "doc", "learned", "text").mapInArrow(_task_entries(shared), ENTRY)
    entries = entries.repartition("w").select(
        "row", "w", "doc", "sums", (F.col("pair") % CLASSES).cast("int").alias("g"),
        F.expr(f"pair div {2 * CLASSES}").alias("n"), F.expr(f"(pair div {CLASSES}) % 2").alias("learned"),
    )
    taught = F.sum(F.coalesce(F.col("n") * F.col("learned"), F.lit(0)))
    counted = entries.withColumn("c2", taught.over(Window.partitionBy("w", "g"))).withColumn(
        "c1", taught.over(Window.partitionBy("w")))
    table = F.broadcast(spark.createDataFrame(
        [(g, int(n), *map(float, mix)) for g, (n, mix) in enumerate(zip(counts.contexts, model.mix))],
        "g int, context bigint, two double, one double, zero double"))
    joined = counted.join(table, "g", "left")
    total = float(max(counts.total, 1))
    estimate = (
        F.col("two") * F.col("c2") / F.greatest("context", F.lit(1))
        + F.col("one") * F.col("c1") / F.lit(total) + F.col("zero") / F.lit(float(size))
    )
    base = F.log10((F.col("c1") + 1) / F.lit(float(counts.total + size)))

    def added(own, of_text):
        return F.sum(F.coalesce(of_text, own))

    n = F.col("n")
    return joined.groupBy("row").agg(
        F.max("doc").alias("doc"),
        F.max("sums.tokens").alias("n_tokens"),
        added(F.when(F.col("c1") > 0, n).otherwise(F.lit(0)), F.col("sums.known")).alias("n_known"),
        added(n * base, F.col("sums.base")).alias("base_score"),
        added(n * F.log10(estimate), F.col("sums.score")).alias("score"),
    )


def numbered(docs: DataFrame, doc="doc_id", text="text") -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc).cast("bigint").alias("doc"),
        (~is_held_out(F.col(doc))).alias("learned"), F.col(text).alias("text"),
    )


def score_texts(docs: DataFrame, doc="doc_id", text="text") -> DataFrame:
    """Learn from the documents that are not held out, and score them all. A token's
    context is the word before it."""
    from newsloom.llm import word_lm  # which uses this module

    chunks = word_lm.chunks_of(numbered(docs, doc, text))
    replies = word_lm.replies_to(chunks)
    model = word_lm.learn(chunks, replies)
    return word_lm.log_scores(chunks, replies, model).select(
        F.col("doc").alias(doc), is_held_out(F.col("doc")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"),
    )


def query(spark, sf_dir) -> DataFrame:
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
