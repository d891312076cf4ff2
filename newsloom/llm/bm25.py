"""Exact top-k search by BM25 with block-max pruning.

The index is a table of documents as sorted term hashes with their frequencies,
one row each. Any group of its rows is a shard: a task turns the rows it reads,
a bounded number of postings at a time, into an inverted index whose postings
are cut into blocks of ``BLOCK`` documents with the largest impact of each.
Document counts, lengths and term frequencies are those of the whole corpus, so
scores from different shards compare and the best of all shards are the exact
top k.

The corpus is searched in rounds. A first small part gives every query a k-th
best score, which is its threshold in the next, larger part.

Queries are scored in groups, documents in tiles of one kind, such as a language,
and like length. Terms that many documents of a tile hold have rows of impacts
there, which are added to the sums of a whole group as one matrix product; the
postings of the other terms are added before. A query whose threshold these sums
and the rows' maxima in the blocks leave out of reach is spared the product. Sums
are of four bytes and choose with room for their error; the documents that they
leave are scored exactly.

A few queries are searched one by one. The weakest terms, those whose largest
impacts together stay below the threshold, cannot make a document rank: the other
terms are added up first, and a block is opened for the weak terms only if its
maxima leave one of its documents in reach. A term that many documents of a shard
hold has a row of impacts on all of them and of maxima of all blocks, which are
added up as arrays. Without a threshold a shard first scores the blocks with the
highest bounds. No document that could rank is skipped; ties are broken by
document id, then row.

Queries come in blocks of bounded size, which are broadcast to the shards; their
number grows with the queries, and nothing of the corpus passes the driver.
Queries of the same terms are asked once. Of documents with the same terms and
counts (told by a 64-bit hash) in one shard, only so many as are wanted are scored.

Words are runs of letters, digits and bytes from 128 on, A-Z in lower case, as
64-bit hashes; a query is the set of its words.

Defined cases: a null, empty or wordless text matches nothing and, as a query,
finds nothing; a null id is indexed and ranks last among ties; repeated rows are
indexed, and asked, each on its own; an empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.llm.winnow import IS_WORD, _mix, byte_class_hashes
from newsloom.session import materialize

K1, B = 1.2, 0.75
TOP = 10
BLOCK = 16  # documents
COMMON = 8  # a term of more than one in so many documents of a shard has a row with all of them
FIRST_BLOCKS = 16  # opened before there is a threshold
FEW = 8  # queries, which are searched one by one
GROUP = 256  # queries that are scored together
TILE = 2048  # like documents that are scored together
COMMON_TERMS = 1 << 12  # of a block of queries: those that may have a row in a tile
ROW_SHARE = 50  # a term of one in so many documents of a tile has a row there
POSTING_COST = 400  # of a posting, in steps of a matrix product
STEPS = 1 << 15  # postings listed at a time
KINDS, KIND_TERMS, KIND_SAMPLE, KIND_ROUNDS = 8, 512, 1 << 12, 8  # of documents, told apart by the commonest terms
PARTS, ROUND_ENDS = 64, (1, 8, 64)  # parts of the corpus that each round has searched by its end
SHARD_POSTINGS = 5 << 19
QUERY_TERMS = 1 << 23  # terms of the queries that are broadcast together
DIGITS = 6  # of a score, in the result and when ranking
SLACK = 10.0 ** -DIGITS

PROFILE = "struct<length:bigint,terms:array<bigint>,counts:array<int>>"


def _profiles(texts: pa.Array) -> pa.Array:
    terms, counts, lengths, offsets = [], [], [], [0]
    for t in texts:
        hashes = byte_class_hashes((t.as_py() or "").encode(), IS_WORD)[0]
        own, n = np.unique(hashes.view(np.int64), return_counts=True)
        terms.append(own)
        counts.append(n.astype(np.int32))
        lengths.append(len(hashes))
        offsets.append(offsets[-1] + len(own))
    offsets = pa.array(offsets, pa.int32())

    def lists(parts, kind):
        values = np.concatenate(parts) if parts else np.empty(0, np.int64)
        return pa.ListArray.from_arrays(offsets, pa.array(values, kind))

    return pa.StructArray.from_arrays(
        [pa.array(lengths, pa.int64()), lists(terms, pa.int64()), lists(counts, pa.int32())],
        ["length", "terms", "counts"],
    )


def build_index(docs: DataFrame, doc="doc_id", text="text") -> DataFrame:
    """(row, doc, length, terms, counts) of every document, stored."""

    @F.arrow_udf(PROFILE)
    def run(texts: pa.Array) -> pa.Array:
        return _profiles(texts)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc).cast("bigint").alias("doc"),
        run(F.col(text)).alias("p"),
    )
    part = F.pmod(F.xxhash64("row"), F.lit(PARTS))
    turn = sum(F.when(part >= end, 1).otherwise(0) for end in ROUND_ENDS[:-1])
    return materialize(rows.select("row", "doc", "p.*", turn.alias("round")), "bm25-index", "round", rebalance=False)


def _flat(column):
    """Values and offsets of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy() - column.offsets[0].as_py()


class Places:
    """Places of terms in a sorted list. Hashes are spread evenly, so their first
    bits tell the place but for a few steps."""

    def __init__(self, terms):
        bits = min(len(terms).bit_length() + 1, 30)
        self.terms, self.shift, self.half = terms, 64 - bits, 1 << (bits - 1)
        self.starts = np.searchsorted(terms >> self.shift, np.arange(-self.half, self.half)).astype(np.int32)

    def of(self, terms):
        """A place for each term, and whether the term stands there."""
        last = len(self.terms) - 1
        place = np.minimum(self.starts[(terms >> self.shift) + self.half], last)
        late = np.flatnonzero(self.terms[place] < terms)
        while len(late := late[place[late] < last]):
            place[late] += 1
            late = late[self.terms[place[late]] < terms[late]]
        return place, self.terms[place] == terms


def _task_frequencies(wanted):
    """Documents that hold each wanted term (sorted), added up per task."""

    def run(batches):
        places, found = Places(wanted.value), np.zeros(len(wanted.value), np.int64)
        for batch in batches:
            place, asked = places.of(_flat(batch.column("terms"))[0])
            found += np.bincount(place[asked], minlength=len(found))
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(found[seen])], names=["term", "n"])

    return run


class Postings:
    """Some documents and their inverted lists, for the terms of some queries."""

    KIND = float  # of impacts

    def __init__(self, batches, queries, top=None):
        """With ``top``, a document that comes after so many with the same terms and
        counts is left out: they have its score and rank before it."""
        ids, rows = pa.concat_arrays([b.column("doc") for b in batches]), np.concatenate([b.column("row").to_numpy() for b in batches])
        null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        lengths = np.concatenate([b.column("length").to_numpy() for b in batches])
        parts, own, ends = [], [], [np.zeros(1, np.int64)]
        for batch in batches:
            terms, offsets = _flat(batch.column("terms"))
            place, asked = queries.places.of(terms)
            place, counts = place[asked], _flat(batch.column("counts"))[0][asked]
            upto = np.append(0, np.cumsum(asked))[offsets]
            parts.append((place, counts))
            ends.append(ends[-1][-1] + upto[1:])
            mixed = _mix(place.astype(np.uint64) << np.uint64(32) | counts.astype(np.uint64))
            mixed = np.append(np.uint64(0), np.cumsum(mixed))[upto]
            own.append(mixed[1:] - mixed[:-1])
        place, counts = (np.concatenate(x) for x in zip(*parts))
        own, ends = np.concatenate(own), np.concatenate(ends)
        docs = np.repeat(np.arange(len(rows), dtype=np.int32), np.diff(ends))
        del batches, parts, terms, asked, mixed
        # documents of one kind and of like length share blocks, which makes the maxima tight
        kinds = queries.kinds_of(docs, place, len(rows))
        order = np.lexsort((lengths, kinds))
        if top:
            like = np.lexsort((rows, ids, null, lengths, own))
            new = np.ones(len(like), bool)
            new[1:] = (own[like][1:] != own[like][:-1]) | (lengths[like][1:] != lengths[like][:-1])
            first = np.maximum.accumulate(np.where(new, np.arange(len(like)), 0))
            late = np.zeros(len(like), bool)
            late[like[np.arange(len(like)) - first >= top]] = True
            order = order[~late[order]]
        self.rows, self.docs, self.null, self.kinds = rows[order], ids[order], null[order], kinds[order]
        # the documents' own lists
        at, sizes = _ranges(ends[order], ends[order + 1]), np.diff(ends)[order]
        self.list_place, self.list_count, self.list_ends = place[at], counts[at], np.append(0, np.cumsum(sizes))
        self.norm = K1 * (1 - B + B * lengths[order] / queries.mean_length)
        docs = np.repeat(np.arange(len(order), dtype=np.int32), sizes)
        del place, counts, at
        # by term, then document
        key = self.list_place.astype(np.int64)
        key <<= 32
        key |= np.arange(len(key))
        key.sort()
        self.place, self.doc, self.impact = (np.empty(len(key), kind) for kind in (np.int32, np.int32, self.KIND))
        for i in range(0, len(key), STEPS):
            cut = slice(i, i + STEPS)
            at, self.place[cut] = key[cut] & 0xFFFFFFFF, key[cut] >> 32
            self.doc[cut], counts = docs[at], self.list_count[at].astype(float)
            self.impact[cut] = queries.idf[self.place[cut]] * counts * (K1 + 1) / (counts + self.norm[self.doc[cut]])
        self.first = np.searchsorted(self.place, np.arange(len(queries.terms) + 1))  # the first posting of each term


class Shard(Postings):
    """An inverted index in blocks with their maxima, which answers queries one by one."""

    def __init__(self, batches, queries):
        super().__init__(batches, queries)
        place = self.place
        # segments: the postings of one term in one block
        blocks = -(-len(self.rows) // BLOCK)
        segment = place.astype(np.int64) * blocks + self.doc // BLOCK
        self.start = np.flatnonzero(np.diff(segment, prepend=-1))
        self.block = (segment[self.start] % blocks).astype(np.int32)
        self.most = np.maximum.reduceat(self.impact, self.start) if len(self.start) else np.empty(0)
        self.of_term = np.searchsorted(segment[self.start], np.arange(len(queries.terms) + 1) * blocks)
        self.peak = np.zeros(len(queries.terms))  # the largest impact of each term
        held = self.of_term[1:] > self.of_term[:-1]
        if held.any():
            self.peak[held] = np.maximum.reduceat(self.most, self.of_term[:-1][held])
        self.start = np.append(self.start, len(self.doc))
        self.blocks = blocks
        self.block_of = np.arange(len(self.rows)) // BLOCK
        # common terms: the impact on every document, and the largest of each block
        held = np.diff(self.first)
        common = np.flatnonzero(held * COMMON > len(self.rows))
        self.common = np.full(len(held), -1, np.int32)
        self.common[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), len(self.rows)))
        at = _ranges(self.first[common], self.first[common + 1])
        self.dense[np.repeat(np.arange(len(common)), held[common]), self.doc[at]] = self.impact[at]
        self.ceiling = np.maximum.reduceat(self.dense, np.arange(0, len(self.rows), BLOCK), axis=1)

    def _open(self, segments, chosen, scores):
        """Add up the impacts of the segments that lie in the chosen blocks."""
        own = segments[chosen[self.block[segments]]]
        at = _ranges(self.start[own], self.start[own + 1])
        return scores + np.bincount(self.doc[at], weights=self.impact[at], minlength=len(scores))

    def _whole(self, terms):
        """The impacts of the terms added up on all documents."""
        rows = self.common[terms]
        rare = terms[rows < 0]
        at = _ranges(self.first[rare], self.first[rare + 1])
        scores = np.bincount(self.doc[at], weights=self.impact[at], minlength=len(self.rows)).astype(float)
        for row in rows[rows >= 0]:
            scores += self.dense[row]
        return scores

    def _bound(self, segments):
        """The most that these segments' terms add to any document, by block."""
        return np.bincount(self.block[segments], weights=self.most[segments], minlength=self.blocks)

    def _segments(self, terms):
        return _ranges(self.of_term[terms], self.of_term[terms + 1])

    def search(self, terms, top, least=0.0):
        """Places and scores of the best documents of this shard, those below
        ``least`` left out."""
        terms = terms[self.of_term[terms + 1] > self.of_term[terms]]
        if not len(terms):
            return np.empty(0, np.int64), np.empty(0)
        scores = rest = None
        if not least and self.blocks > FIRST_BLOCKS:
            scores = np.zeros(len(self.rows))
            segments = self._segments(terms)
            bound = self._bound(segments)
            first = np.zeros(self.blocks, bool)
            first[np.argpartition(-bound, FIRST_BLOCKS)[:FIRST_BLOCKS]] = True
            scores = self._open(segments, first, scores)
            least = np.partition(scores, -top)[-top] if len(scores) > top else 0.0
            rest = ~first & (bound >= least - 2 * SLACK)
        least = max(least - 2 * SLACK, 0.0)
        # terms that together cannot reach the threshold are looked up last, and
        # only in blocks where the others leave a document in reach
        order = np.argsort(self.peak[terms])
        weak = np.cumsum(self.peak[terms][order]) < least
        strong, weak = terms[order[~weak]], terms[order[weak]]
        if rest is None:
            scores = self._whole(strong)
            near = np.flatnonzero(scores > 0)
        else:
            scores = self._open(self._segments(strong), rest, scores)
            near = np.flatnonzero((scores > 0) & rest[self.block_of])
        if len(weak):
            rows = self.common[weak]
            segments, rows = self._segments(weak[rows < 0]), rows[rows >= 0]
            rare, bound = self._bound(segments), self.ceiling[rows].sum(axis=0)
            near = near[scores[near] + (rare + bound)[self.block_of[near]] >= least]
            scores[near] += self.dense[rows[:, None], near].sum(axis=0)
            near = near[scores[near] + rare[self.block_of[near]] >= least]
            last = np.zeros(self.blocks, bool)
            last[self.block_of[near]] = True
            scores = self._open(segments, last, scores)
        # all others miss weak terms, or were not opened, and are too low to rank
        found = near if rest is None else np.append(np.flatnonzero((scores > 0) & ~rest[self.block_of]), near)
        found = found[scores[found] >= least]
        if len(found) > top:
            least = np.partition(scores[found], -top)[-top]
            found = found[scores[found] >= least - 2 * SLACK]
        rounded = np.round(scores[found], DIGITS)
        order = np.lexsort((self.rows[found], self.docs[found], self.null[found], -rounded))[:top]
        return found[order], rounded[order]


def _ranges(starts, ends):
    """All numbers of some ranges, one after the other."""
    sizes = ends - starts
    out = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    out += np.arange(len(out))
    return out


POSTING = np.dtype([("column", "<i4"), ("weight", "<f4")])


class Tiles(Postings):
    """An inverted index in tiles of like documents, which answers queries in groups.

    A term that many documents of a tile hold has a row of impacts on all of them,
    and one of the maxima of blocks. The impacts of rare terms are added up posting
    by posting; where these sums and the maxima of the rows leave a query's k-th
    best score in reach of a block, the rows are added as a matrix product. Sums
    are of four bytes and only choose, with room for their error; what they leave
    is scored again exactly.
    """

    KIND = np.float32

    def __init__(self, batches, queries, top):
        super().__init__(batches, queries, top)
        self.queries, self.top = queries, top
        n = len(self.rows)
        edges = np.append(np.flatnonzero(np.diff(self.kinds, prepend=-1)), n)
        edges = np.unique(np.concatenate([np.linspace(a, b, -(-(b - a) // TILE) + 1).astype(int) for a, b in zip(edges, edges[1:])]))
        self.sizes = np.diff(edges)
        tile = np.repeat(np.arange(len(self.sizes)), self.sizes)
        # columns: the first documents of all blocks of a tile, then the second ones, and so on
        blocks = -(-self.sizes // BLOCK)
        self.edges = np.append(0, np.cumsum(blocks * BLOCK))
        own = np.arange(n) - edges[tile]
        column = (self.edges[tile] + own % BLOCK * blocks[tile] + own // BLOCK).astype(np.int32)
        self.at_column = np.zeros(self.edges[-1], np.int32)
        self.at_column[column] = np.arange(n)
        n_tiles, n_common = len(self.sizes), len(queries.common)
        self.postings, held = np.empty(len(self.doc), POSTING), np.zeros(n_common * n_tiles, np.int64)
        for i in range(0, len(self.doc), STEPS):
            cut = slice(i, i + STEPS)
            self.postings["column"][cut], self.postings["weight"][cut] = column[self.doc[cut]], self.impact[cut]
            common = queries.common_of[self.place[cut]].astype(np.int64) * n_tiles + tile[self.doc[cut]]
            held += np.bincount(common[common >= 0], minlength=len(held))
        del self.impact, self.doc, self.place
        # postings of each common term in each tile
        held = held.reshape(n_common, n_tiles)
        self.starts = self.first[queries.common][:, None] + np.append(np.zeros((n_common, 1), np.int64), np.cumsum(held, axis=1), axis=1)
        self.terms, self.held, self.dense, self.ceiling = [], [], [], []
        for c in range(n_tiles):
            terms = np.argsort(-held[:, c], kind="stable")  # those of most documents first
            terms = terms[: np.count_nonzero(held[:, c] * ROW_SHARE > self.sizes[c])]
            dense = np.zeros((len(terms), blocks[c] * BLOCK), np.float32)
            own = self.postings[_ranges(self.starts[terms, c], self.starts[terms, c + 1])]
            dense[np.repeat(np.arange(len(terms)), held[terms, c]), own["column"] - self.edges[c]] = own["weight"]
            self.terms.append(terms)
            self.held.append(held[terms, c])
            self.dense.append(dense)
            self.ceiling.append(dense.reshape(len(terms), BLOCK, blocks[c]).max(axis=1))

    def _add(self, sums, starts, ends, base):
        """Add the impacts of some ranges of postings; the base says to which row of the sums."""
        upto = np.append(0, np.cumsum(ends - starts))
        cuts = np.searchsorted(upto[1:], np.arange(0, upto[-1], STEPS), side="right").tolist()
        words = self.postings.view("<i8")
        for i, j in zip(cuts, [*cuts[1:], len(starts)]):
            own = words.take(_ranges(starts[i:j], ends[i:j]))
            at = np.repeat(base[i:j], ends[i:j] - starts[i:j])
            at += own & 0xFFFFFFFF  # the column
            np.add.at(sums, at, own.view(POSTING)["weight"])

    def _sums(self, lists, reach):
        """Impacts of each list's terms added up, by list and column; those below
        ``reach`` may be lower than they are."""
        count, queries = len(lists), self.queries
        row, place = np.repeat(np.arange(count), [len(x) for x in lists]), np.concatenate(lists)
        common = queries.common_of[place]
        rare = np.flatnonzero(common < 0)
        rare_row, rare = row[rare], place[rare]
        often = np.flatnonzero(common >= 0)
        row, common = row[often], common[often]
        asked = np.bincount(common, minlength=len(queries.common))
        # a product takes the first rows of a tile, as many as it adds in less time than postings
        used, apart = [], np.zeros((len(asked), len(self.sizes) + 2), bool)
        for c, terms in enumerate(self.terms):
            gain = np.cumsum(asked[terms] * self.held[c] * POSTING_COST - count * self.sizes[c])
            used.append(np.argmax(gain) + 1 if len(gain) and gain.max() > 0 else 0)
            apart[terms[: used[c]], c + 1] = True
        # the other postings: those of rare terms, and those of common ones from tile to tile
        apart[asked == 0] = True
        apart[:, [0, -1]] = True
        term, tile = np.nonzero(apart[:, :-1] & ~apart[:, 1:])
        end = np.nonzero(~apart[:, :-1] & apart[:, 1:])[1]
        lo, hi = self.starts[term, tile], self.starts[term, end]
        held = hi > lo
        term, lo, hi = term[held], lo[held], hi[held]
        runs = np.searchsorted(term, np.arange(len(asked) + 1))
        at = _ranges(runs[common], runs[common + 1])
        starts, ends = np.append(self.first[rare], lo[at]), np.append(self.first[rare + 1], hi[at])
        rows = np.append(rare_row, np.repeat(row, runs[common + 1] - runs[common]))
        held = np.flatnonzero(ends > starts)
        held = held[np.argsort(rows[held], kind="stable")]
        sums = np.zeros((count, self.edges[-1]), np.float32)
        self._add(sums.reshape(-1), starts[held], ends[held], rows[held] * self.edges[-1])
        for c, n in enumerate(used):
            if not n:
                continue
            at = np.full(len(asked), -1, np.int16)
            at[self.terms[c][:n]] = np.arange(n)
            at = at[common]
            inside = np.flatnonzero(at >= 0)
            matrix = np.zeros((count, n), np.float32)
            matrix[row[inside], at[inside]] = 1
            part = sums[:, self.edges[c] : self.edges[c + 1]]
            bound = part.reshape(count, BLOCK, -1).max(axis=1) + matrix @ self.ceiling[c][:n]
            near = np.flatnonzero((bound >= reach[:, None]).any(axis=1))
            if 4 * len(near) > 3 * count:
                part += matrix @ self.dense[c][:n]
            elif len(near):
                part[near] += matrix[near] @ self.dense[c][:n]
        return sums

    def _exact(self, row, doc, lists):
        """Scores of the documents, for the query of each."""
        out, mark = np.empty(len(row)), np.zeros(len(self.queries.terms), bool)
        starts, ends, norms = self.list_ends[doc].tolist(), self.list_ends[doc + 1].tolist(), self.norm[doc].tolist()
        cuts = np.flatnonzero(np.diff(row, prepend=-1, append=len(lists)))
        for i, j in zip(cuts.tolist(), cuts[1:].tolist()):
            mark[lists[row[i]]] = True
            for k in range(i, j):
                place = self.list_place[starts[k] : ends[k]]
                asked = np.flatnonzero(mark[place])
                counts = self.list_count[starts[k] : ends[k]][asked]
                out[k] = (self.queries.idf[place[asked]] * counts * (K1 + 1) / (counts + norms[k])).sum()
            mark[lists[row[i]]] = False
        return out

    def search(self, lists, least):
        """Places in ``lists``, of documents and scores of the best documents for
        each list of terms, those below its ``least`` left out."""
        # a sum of n addends of four bytes is off by less than this share
        error = np.array([len(x) + 4 for x in lists]) * 2.0**-23
        reach = np.maximum(least - 2 * SLACK, 0) * (1 - error)
        sums = self._sums(lists, reach.astype(np.float32))
        free = np.flatnonzero(reach == 0)
        if len(free) and sums.shape[1] > self.top:
            last = np.partition(sums[free], -self.top, axis=1)[:, -self.top].astype(float)
            reach[free] = np.maximum(last - 2 * SLACK, 0) * (1 - 2 * error[free])
        reach = np.maximum(np.nextafter(reach.astype(np.float32), np.float32(0)), np.finfo(np.float32).smallest_subnormal)
        near = (sums >= reach[:, None]).reshape(-1)
        words = np.flatnonzero(near.view(np.uint64))  # eight at a time: widths are multiples of a block
        at = (words[:, None] * 8 + np.arange(8)).reshape(-1)
        row, column = np.divmod(at[near[at]], sums.shape[1])
        doc = self.at_column[column]
        scores = self._exact(row, doc, lists)
        near = scores >= least[row] - 2 * SLACK
        row, doc, scores = row[near], doc[near], np.round(scores[near], DIGITS)
        order = np.lexsort((self.rows[doc], self.docs[doc], self.null[doc], -scores, row))
        row, doc, scores = row[order], doc[order], scores[order]
        first = np.searchsorted(row, row)
        best = np.arange(len(row)) - first < self.top
        return row[best], doc[best], scores[best]


class Queries:
    """A block of queries: their terms as places in one sorted list, with weights."""

    def __init__(self, rows, ids, lists, terms, idf, mean_length):
        self.terms, self.idf, self.mean_length = terms, idf, mean_length
        self.least = {}  # thresholds by row
        self.places = Places(terms)
        self.common = np.argsort(idf, kind="stable")[:COMMON_TERMS]  # the commonest first
        self.common_of = np.full(len(terms), -1, np.int16)
        self.common_of[self.common] = np.arange(len(self.common))
        # queries of the same terms are asked once
        asked = {}
        for k, own in enumerate(lists):
            asked.setdefault(own.tobytes(), []).append(k)
        lists = [np.searchsorted(terms, lists[own[0]]).astype(np.int32) for own in asked.values()]
        rows, ids = ([[x[k] for k in own] for own in asked.values()] for x in (rows, ids))
        self.centres = None
        sample = lists[:: max(1, -(-len(lists) // KIND_SAMPLE))]
        if len(sample) >= KINDS:
            places = np.concatenate(sample)
            self.centres = _centres(self._common_words(np.repeat(np.arange(len(sample)), [len(x) for x in sample]), places, len(sample)))
        # queries of one kind and of like length are asked together
        kinds = self.kinds_of(np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate([np.empty(0, np.int32), *lists]), len(lists))
        order = np.lexsort(([len(x) for x in lists], kinds))
        self.rows, self.ids, self.lists = [rows[i] for i in order], [ids[i] for i in order], [lists[i] for i in order]

    def _common_words(self, docs, places, count):
        words = self.common_of[places]
        held = (words >= 0) & (words < KIND_TERMS)
        matrix = np.zeros((count, KIND_TERMS), np.float32)
        matrix[docs[held], words[held]] = 1
        return matrix

    def kinds_of(self, docs, places, count):
        """A kind of each of some documents, given as (document, place of a term)."""
        if self.centres is None:
            return np.zeros(count, np.int64)
        return np.argmax(self._common_words(docs, places, count) @ self.centres.T, axis=1)


def _centres(words):
    """Centres of clusters of documents by cosine."""
    words = words[words.any(axis=1)]
    if len(words) < KINDS:
        return None
    words = words / np.linalg.norm(words, axis=1, keepdims=True)
    random = np.random.default_rng(0)
    centres, far = words[:1], np.ones(len(words))
    while len(centres) < KINDS:
        far = np.minimum(far, np.maximum(1 - words @ centres[-1], 1e-6))
        centres = np.vstack([centres, words[random.choice(len(words), p=far / far.sum())]])
    for _ in range(KIND_ROUNDS):
        kinds = np.argmax(words @ centres.T, axis=1)
        for k in np.unique(kinds):
            centres[k] = words[kinds == k].sum(axis=0)
        centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    return centres


def _task_search(shared, top):
    names = ["query_row", "query_id", "row", "doc", "score"]

    def batch_of(queries, own, shard, found, scores):
        each = [len(queries.rows[k]) for k in own]
        rows, ids = ([x for k in own for x in of[k]] for of in (queries.rows, queries.ids))
        found, scores = np.repeat(found, each), np.repeat(scores, each)
        docs = pa.array(shard.docs[found], pa.int64(), mask=shard.null[found])
        parts = [pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(shard.rows[found], pa.int64()), docs]
        return pa.RecordBatch.from_arrays([*parts, pa.array(scores, pa.float64())], names=names)

    def answers(batches):
        queries = shared.value
        least = np.array([queries.least.get(rows[0], 0.0) for rows in queries.rows])
        if len(queries.rows) <= FEW:
            shard = Shard(batches, queries)
            for k, terms in enumerate(queries.lists):
                found, scores = shard.search(terms, top, least[k])
                yield batch_of(queries, [k] * len(found), shard, found, scores)
            return
        tiles = Tiles(batches, queries, top)
        batches.clear()
        for i in range(0, len(queries.rows), GROUP):
            own, found, scores = tiles.search(queries.lists[i : i + GROUP], least[i : i + GROUP])
            yield batch_of(queries, (own + i).tolist(), tiles, found, scores)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(_flat(batch.column("terms"))[0])
            if size >= SHARD_POSTINGS:
                yield from answers(held)
                held, size = [], 0
        if held:
            yield from answers(held)

    return run


FOUND = "query_row bigint, query_id bigint, row bigint, doc bigint, score double"


def search(index: DataFrame, queries: DataFrame, top=TOP) -> DataFrame:
    """The best ``top`` documents of the index for each query, a row of
    (row, doc, terms): (query_row, query_id, rank, row, doc, score)."""
    spark = index.sparkSession
    size = index.agg(F.count("*").alias("n"), F.coalesce(F.avg("length"), F.lit(0.0)).alias("mean")).first()
    asked = materialize(queries.select("row", "doc", "terms").filter(F.size("terms") > 0), "bm25-queries")
    n_terms = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-n_terms // QUERY_TERMS))
    parts = []
    for b in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).toArrow()
        if not len(own):
            continue
        values, offsets = _flat(own["terms"])
        terms = np.unique(values)
        wanted = spark.sparkContext.broadcast(terms)
        counts = index.select("terms").mapInArrow(_task_frequencies(wanted), "term bigint, n bigint")
        sums = counts.groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # the block's terms at most
        df = np.zeros(len(terms))
        df[sums["term"].to_numpy()] = sums["n"].to_numpy()
        idf = np.log(1 + (size["n"] - df + 0.5) / (df + 0.5))
        lists = [values[i:j] for i, j in zip(offsets, offsets[1:])]
        block = Queries(own["row"].to_pylist(), own["doc"].to_pylist(), lists, terms, idf, max(size["mean"], 1e-9))
        best = None
        for turn, (begin, end) in enumerate(zip((0, *ROUND_ENDS), ROUND_ENDS)):
            shared = spark.sparkContext.broadcast(block)
            # large shards, as each takes the whole block of queries, but all cores busy
            shards = int(max(df.sum() * (end - begin) / PARTS / SHARD_POSTINGS, 3 * spark.sparkContext.defaultParallelism))
            part = index.filter(F.col("round") == turn).drop("round").coalesce(shards)
            found = part.mapInArrow(_task_search(shared, top), FOUND)
            best = found if best is None else best.select(found.columns).unionByName(found)
            best = materialize(_best(best, top), "bm25-found")
            if turn + 1 < len(ROUND_ENDS):  # one number for each query of the block
                block.least = {r["query_row"]: r["score"] for r in best.filter(F.col("rank") == top).collect()}
        parts.append(best)
    if not parts:
        return spark.createDataFrame([], "query_row bigint, query_id bigint, rank int, row bigint, doc bigint, score double")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _best(found, top):
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("doc"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("query_row", "query_id", "rank", "row", "doc", "score")


def query(spark, sf_dir) -> DataFrame:
    index = build_index(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    found = search(index, index.filter(F.col("doc") % 50 == 0))
    return found.select("query_id", "rank", F.col("doc").alias("doc_id"), "score")


ORACLE = r"""
with d as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as ws from documents
), tf as (select doc_id, w, count(*) as n from (select doc_id, unnest(ws) as w from d) group by all),
idf as (select w, ln(1 + ((select count(*) from d) - count(*) + 0.5) / (count(*) + 0.5)) as idf from tf group by w),
sizes as (select doc_id, len(ws) as len, avg(len(ws)) over () as mean from d),
scores as (
  select q.doc_id as query_id, t.doc_id, round(sum(idf * t.n * 2.2 / (t.n + 1.2 * (0.25 + 0.75 * s.len / s.mean))), 6) as score
  from tf q join tf t using (w) join idf using (w) join sizes s on s.doc_id = t.doc_id
  where q.doc_id % 50 = 0 group by all)
select query_id, cast(row_number() over (partition by query_id order by score desc, doc_id) as int) as rank, doc_id, score
from scores qualify rank <= 10
"""
