"""Benchmark decontamination by winnowing.

A window is ``length`` consecutive words of a benchmark item (a shorter item is
one window). Its fingerprint is the least k-gram hash among the window's
k-grams, the last one on ties. A document keeps the fingerprints of all its own
windows, so two equal windows always share one: every shared span of at least
``length`` words is found. Document and benchmark fingerprints are joined, and a
hit is extended to its window, word by word, before it counts.

Only fingerprints that pass a Bloom filter of the benchmark's leave a document's
row. The filter has a fixed size; when a huge benchmark fills it, more rows are
joined and nothing else changes. Each of them carries the words around it, so
that texts are read once and never shuffled.

Lengths: a window of g words uses k-grams of k = (g + 1) // 2 words, minima over
g - k + 1 of them. Short items are looked for once per length that occurs.

Defined cases: null and wordless texts have no words and no hits; an item
without words has no window; a null item id marks words but is no item; repeated
documents are each reported, repeated items once; an empty benchmark leaves
every document clean; an empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import broadcast_if_small, materialize

WINDOW = 10
FILTER_BITS = 23  # the Bloom filter has 2**23 bits, 1 MiB
GROUP_BYTES = 4 << 20  # texts handled together
SEGMENT_BYTES = 1 << 20  # bytes hashed together

_byte = np.arange(256)
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint64)
IS_WORD = ((_byte >= 48) & (_byte <= 57)) | ((_byte | 32) >= 97) & ((_byte | 32) <= 122) & (_byte < 128) | (_byte >= 128)
# Odd multipliers of the polynomial hashes, modulo 2**64.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def _powers(base, n):
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _mix(x):
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


_tables = {}


def _power_tables(n):
    if _tables.get("n", 0) < n:
        inverse = pow(BYTE_BASE, -1, 1 << 64)
        _tables.update(n=n, up=_powers(BYTE_BASE, n), down=_powers(inverse, n))
    return _tables["up"], _tables["down"]


def byte_class_hashes(data: bytes, is_word):
    """(hash, start, end) of every run of word bytes of some UTF-8 text, with A-Z
    in lower case. ``is_word`` has a flag for each byte.

    A word's bytes weigh by their place in the segment, and the weight of its
    first place is divided out, so all words are hashed in a few array steps.
    """
    raw = np.frombuffer(data, np.uint8)
    word = is_word[raw]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, base + SEGMENT_BYTES, "right")))
        n = int(ends[upto - 1] - base)
        up, down = _power_tables(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((LOWER[raw[base:base + n]] + np.uint64(1)) * up[:n], out=sums[1:])
        s, e = starts[at:upto] - base, ends[at:upto] - base
        hashes[at:upto] = _mix((sums[e] - sums[s]) * down[s])
        at = upto
    return hashes, starts, ends


def fingerprints(hashes, text_of, length):
    """(position, hash) of the k-grams that winnowing keeps. ``text_of`` has the
    number of each word's text; no window reaches into the next text."""
    k = (length + 1) // 2
    span = length - k + 1
    windows = len(hashes) - length + 1
    if windows <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = np.zeros(len(hashes) - k + 1, np.uint64)
    for j in range(k):
        grams = grams * np.uint64(WORD_BASE) + hashes[j:j + len(grams)]
    grams = _mix(grams + np.uint64(length))
    best, place = grams[:windows].copy(), np.zeros(windows, np.int64)
    for j in range(1, span):
        later = grams[j:j + windows]
        better = later <= best
        best[better] = later[better]
        place[better] = j
    inside = text_of[:windows] == text_of[length - 1:]
    kept = np.unique((np.arange(windows) + place)[inside])
    return kept, grams[kept]


def _groups(texts):
    """Runs of texts of bounded size, joined by a byte that is no part of a word."""
    group, size = [], 0
    for text in texts:
        data = (text.as_py() or "").encode()
        if group and size + len(data) > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(data)
        size += len(data)
    if group:
        yield group


def _words_of(group):
    data = b"\n".join(group)
    hashes, starts, ends = byte_class_hashes(data, IS_WORD)
    borders = np.cumsum([len(d) + 1 for d in group])
    text_of = np.searchsorted(borders, starts, "right")
    return data, hashes, starts, ends, text_of


def _word_list(data, starts, ends, a, b):
    return [data[s:e].lower().decode() for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())]


HITS = pa.list_(pa.struct([
    ("pos", pa.int32()), ("hash", pa.int64()), ("length", pa.int32()),
    ("before", pa.int32()), ("around", pa.list_(pa.string())),
]))
HITS_SQL = "array<struct<pos:int,hash:bigint,length:int,before:int,around:array<string>>>"


def scan_texts(texts, lengths, bits):
    """Word counts, and for each text the fingerprints that pass the filter with
    the words around them."""
    counts, found = [], []
    for group in _groups(texts):
        data, hashes, starts, ends, text_of = _words_of(group)
        first = np.searchsorted(text_of, np.arange(len(group) + 1))
        counts.append(np.diff(first))
        hits = [[] for _ in group]
        for length in lengths:
            pos, kept = fingerprints(hashes, text_of, length)
            slot = (kept >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            passed = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 != 0
            k = (length + 1) // 2
            for p, h in zip(pos[passed].tolist(), kept[passed].view(np.int64).tolist()):
                t = int(text_of[p])
                a, b = max(int(first[t]), p - (length - k)), min(int(first[t + 1]), p + length)
                hits[t].append({"pos": p - int(first[t]), "hash": h, "length": length, "before": p - a,
                                "around": _word_list(data, starts, ends, a, b)})
        found += hits
    counts = np.concatenate(counts) if counts else np.empty(0, np.int64)
    return pa.StructArray.from_arrays(
        [pa.array(counts, pa.int64()), pa.array(found, HITS)], ["n_words", "hits"]
    )


def windows_of(text, window):
    """(length, hash, offset, words) of each window of one benchmark text."""
    data, hashes, starts, ends, text_of = _words_of([text.encode()])
    n = len(hashes)
    length = min(n, window)
    if not length:
        return []
    out = []
    for s in range(n - length + 1):
        pos, kept = fingerprints(hashes[s:s + length], text_of[s:s + length], length)
        out.append((length, int(kept.view(np.int64)[0]), int(pos[0]),
                    " ".join(_word_list(data, starts, ends, s, s + length))))
    return out


def benchmark_windows(benchmark: DataFrame, item="item_id", text="text", window=WINDOW) -> DataFrame:
    """Every window of every item: (item, length, hash, offset, window)."""

    @F.arrow_udf("array<struct<length:int,hash:bigint,offset:int,window:string>>")
    def run(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("length", pa.int32()), ("hash", pa.int64()), ("offset", pa.int32()),
                                   ("window", pa.string())]))
        names = ["length", "hash", "offset", "window"]
        return pa.array([[dict(zip(names, w)) for w in windows_of(t.as_py() or "", window)] for t in texts], kind)

    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.explode(run(F.col(text))).alias("w"))
    return materialize(rows.select("item", "w.*"), "benchmark-windows")


def _filter_bits(windows: DataFrame):
    """The Bloom filter as bytes: at most 2**17 rows come to the driver."""
    slot = F.shiftrightunsigned(F.col("hash"), 64 - FILTER_BITS)
    rows = (
        windows.select(slot.alias("slot"))
        .selectExpr("shiftright(slot, 6) as word", "shiftleft(1L, cast(slot & 63 as int)) as bit")
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    )
    words = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in rows:
        words[row["word"]] = row["bits"]
    return words.view(np.uint8)


def scan(docs: DataFrame, benchmark: DataFrame, text="text", keep=None, window=WINDOW):
    """(table, marks). ``table`` has the ``keep`` columns of docs (all of them
    if None) as the struct ``kept``, and ``row`` and ``n_words``; ``marks`` has a
    row per contaminated document: ``row``, ``spans`` (start, end in words; each
    a window) and ``items`` (ids as sorted strings)."""
    spark = docs.sparkSession
    windows = benchmark_windows(benchmark, window=window)
    lengths = [r["length"] for r in windows.select("length").distinct().collect()]  # at most `window` values
    shared = spark.sparkContext.broadcast(_filter_bits(windows))

    @F.arrow_udf(f"struct<n_words:bigint,hits:{HITS_SQL}>")
    def run(texts: pa.Array) -> pa.Array:
        return scan_texts(texts, lengths, shared.value)

    keep = docs.columns if keep is None else keep
    scanned = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), run(F.col(text)).alias("found"))
    scanned = scanned.select("kept", F.monotonically_increasing_id().alias("row"), "found.n_words", "found.hits")
    # stored, so that row numbers stay as they are and texts are scanned once
    scanned = materialize(scanned, "fingerprint-hits")
    hits = scanned.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    distinct = windows.select("length", "hash", "offset", "window").distinct()
    joined = hits.join(broadcast_if_small(distinct, store="window-fingerprints"), ["hash", "length"])
    here = F.when(
        F.col("before") >= F.col("offset"),
        F.array_join(F.slice("around", F.col("before") - F.col("offset") + 1, F.col("length")), " "),
    )
    verified = materialize(
        joined.filter(here == F.col("window")).select(
            "row", (F.col("pos") - F.col("offset")).alias("start"),
            (F.col("pos") - F.col("offset") + F.col("length")).alias("end"), "window",
        ),
        "benchmark-hits",
    )
    spans = verified.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    items = broadcast_if_small(windows.select("window", "item").distinct(), store="window-items")
    named = (
        verified.select("row", "window").distinct().join(items, "window")
        .groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    marks = spans.join(named, "row", "left").select("row", "spans", "items")
    return scanned.drop("hits"), marks


def covered(spans):
    """Words inside at least one of some sorted spans."""
    return F.aggregate(
        spans, F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["upto"], s["end"]).alias("upto"),
            (acc["n"] + F.greatest(s["end"] - F.greatest(acc["upto"], s["start"]), F.lit(0))).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def digest(table: DataFrame, marks: DataFrame) -> DataFrame:
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce(covered(F.col("spans")), F.lit(0)).cast("bigint")
    return table.join(marks, "row", "left").select(
        "kept.doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text="text") -> DataFrame:
    """The documents without any benchmark window, as they are."""
    table, marks = scan(docs, benchmark, text)
    bad = broadcast_if_small(marks.select("row"), store="contaminated")
    return table.join(bad, "row", "left_anti").select("kept.*")


def query(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digest(*scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"]))


ORACLE = r"""
with d as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as ws from documents
), b as (
  select item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as ws from benchmark
), lens as (select distinct least(len(ws), 10) as g from b where len(ws) > 0),
iw as (
  select item_id, g, array_to_string(ws[s:s + g - 1], ' ') as win from (
    select item_id, ws, least(len(ws), 10) as g, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) as s
    from b where len(ws) > 0)
), dw as (
  select doc_id, g, s, array_to_string(ws[s:s + g - 1], ' ') as win from (
    select doc_id, ws, g, unnest(range(1, len(ws) - g + 2)) as s from d, lens where len(ws) >= g)
), hits as (select distinct doc_id, s, g, win from dw where (g, win) in (select g, win from iw)),
words as (select doc_id, count(distinct p) as n_hit from (
  select doc_id, unnest(range(s, s + g)) as p from hits) group by doc_id),
items as (select doc_id, count(*) as n, string_agg(i, ',' order by i) as ids from (
  select distinct h.doc_id, cast(iw.item_id as varchar) as i from hits h join iw using (g, win)) group by doc_id)
select d.doc_id, len(d.ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""
