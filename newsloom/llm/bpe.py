"""Byte-pair encoding and decoding of whole texts with a given vocabulary.

The encoder backtracks: an Aho-Corasick automaton over the tokens gives the
longest token at every position of a word, and a pair is accepted only if no
merge would have crossed the border between its two tokens, which the table of
merges decides. The first path to the end is the sequence that the merges
themselves give, and the work is linear in the word. The decoder gathers bytes
from one table of all tokens by their offsets.

The vocabulary file (JSON of the public ``tokenizers`` library, byte-level, a
few MB) is read once on the driver and broadcast; its size is checked. Texts
stay in their rows: nothing is shuffled, and a lost task is simply run again.

Defined cases: a null text has no tokens and decodes to the empty string, as
the empty text does; null ids are read as no ids; ids outside the vocabulary
are left out when decoding, and bytes that are no UTF-8 become U+FFFD; the
special token's string in a text is its single id. Rows and further columns
stay as they are, repeated rows included.
"""

import hashlib
import json
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY_BYTES = 64 << 20  # a larger file is refused: it would be broadcast
REMEMBERED = 400_000  # words, and pairs, a worker remembers; a memo without effect on results
REMEMBERED_CHARS = 40
CHUNK = 1 << 20  # tokens decoded at a time
LATIN_END = "\u0250"  # letters before it are letters in every version of Unicode
WHITE_SPACE_RUN = re.compile(r"[ \n]\s|\s[ \n]")


def byte_alphabet():
    """The printable character that stands for each byte: itself if printable in
    Latin-1, else the next free one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars, free = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in chars:
            chars[b] = chr(free)
            free += 1
    return [chars[b] for b in range(256)]


class Vocabulary:
    """Tables of one vocabulary. Inside, a token is known by its rank: single
    bytes come first, then merged tokens in the order of their merges."""

    def __init__(self, spec: str, pattern: str, remembered: int = REMEMBERED):
        import ahocorasick
        import regex

        data = json.loads(spec)
        model, alphabet = data["model"], byte_alphabet()
        self.words = regex.compile(pattern)
        self.spelling = str.maketrans({chr(b): c for b, c in enumerate(alphabet)})
        names, rank_of = list(alphabet), {c: r for r, c in enumerate(alphabet)}
        self.left, self.right, self.pairs = [*range(256)], [*range(256)], {}
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            rank = len(names)
            names.append(a + b)
            rank_of[a + b] = rank
            self.left.append(rank_of[a])
            self.right.append(rank_of[b])
            self.pairs[rank_of[a], rank_of[b]] = rank
        self.length = [len(n) for n in names]
        self.widest = max(self.length)
        self.id_of = [model["vocab"][n] for n in names]
        self.shorter = []  # the longest token that is a proper prefix, or -1
        for name in names:
            cut = next((rank_of[name[:i]] for i in range(len(name) - 1, 0, -1) if name[:i] in rank_of), -1)
            self.shorter.append(cut)
        self.automaton = ahocorasick.Automaton()
        for rank, name in enumerate(names):
            self.automaton.add_word(name, rank)
        self.automaton.make_automaton()
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.specials = regex.compile(
            "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)"
        )
        self.joins = Memo(lambda pair: self._compatible(*pair), remembered)
        self.plain = Memo(lambda text: self._chunk_ids(text) if text else b"", remembered)  # as at the start of a line
        self.spaced = Memo(lambda text: self._chunk_ids(" " + text), remembered)  # after a space
        self.packed = [array("i", [i]).tobytes() for i in self.id_of]
        self._offsets(alphabet, model["vocab"])

    def _offsets(self, alphabet, vocab):
        byte_of = {c: b for b, c in enumerate(alphabet)}
        spelled = {i: bytes(byte_of[c] for c in name) for name, i in vocab.items()}
        spelled |= {i: name.encode() for name, i in self.special.items()}
        size = max(spelled, default=-1) + 1
        lengths = [len(spelled.get(i, b"")) for i in range(size)]
        self.offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(spelled.get(i, b"") for i in range(size)), np.uint8)

    def _compatible(self, a, b):
        """Whether tokens a and b stay apart when their bytes are merged: undo the
        later of the two, step by step, and see that no earlier merge joins the
        pieces that meet at the border."""
        limit = 1 << 62
        while True:
            joined = self.pairs.get((a, b))
            if joined is not None and joined < limit:
                return False
            if a > b:
                if a < 256:
                    return True
                limit, a = a, self.right[a]
            else:
                if b < 256:
                    return True
                limit, b = b + 1, self.left[b]

    def word_ids(self, word):
        """The ids of one word, as the bytes of an int32 array."""
        if word.isascii():
            text = word.translate(self.spelling)
        else:
            text = word.encode().decode("latin-1").translate(self.spelling)
        joins, longest, packed = self.joins, self.automaton.iter_long, self.packed
        path = [rank for _, rank in longest(text)]
        last = path[0]
        for wrong, token in enumerate(path):
            if wrong and not joins[last, token]:
                break
            last = token
        else:
            return b"".join([packed[r] for r in path])
        # go on from the first border that a merge would have crossed
        length, shorter, widest, n = self.length, self.shorter, self.widest, len(text)
        token, path = shorter[token], path[:wrong]
        at = sum([length[r] for r in path])
        dead = set()  # borders from which no path leads to the end
        while at < n:
            if token < 0:
                dead.add(at)
                token = path.pop()
                at -= length[token]
            elif (not path or joins[path[-1], token]) and at + length[token] not in dead:
                path.append(token)
                at += length[token]
                if at < n:
                    token = next(longest(text[at:at + widest]))[1]
                continue
            token = shorter[token]
        return b"".join([packed[r] for r in path])

    def _split_ids(self, text):
        """The ids of a text, word by word of the pattern."""
        spaced, plain = self.spaced, self.plain
        return b"".join([
            spaced[w[1:]] if w[0] == " " and len(w) > 1 and w[1] != " " else plain[w] for w in self.words.findall(text)
        ])

    def _chunk_ids(self, text):
        """The ids of what stands between spaces and line ends: a word or several."""
        bare = text[1:] if text[0] == " " else text
        if bare.isalpha() and max(bare) < LATIN_END or len(self.words.match(text)[0]) == len(text):
            return self.word_ids(text)
        return self._split_ids(text)

    def _lines(self, text):
        """The same for a text in which white space never meets a space or line
        end: there the pattern always splits before a space and around a line
        end, so what lies between them is looked up as a whole."""
        newline, plain, spaced = self.plain["\n"], self.plain, self.spaced.__getitem__
        parts = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            parts.append(plain[first])
            parts += map(spaced, rest)
            parts.append(newline)
        return b"".join(parts[:-1])

    def _ids(self, text):
        if WHITE_SPACE_RUN.search(text) or text[:1].isspace() or text[-1:].isspace():
            return self._split_ids(text)
        return self._lines(text)

    def encode(self, text):
        """The ids of a text as an int32 array."""
        parts, at = [], 0
        for m in self.specials.finditer(text) if any(map(text.__contains__, self.special)) else ():
            parts += [self._ids(text[at:m.start()]), array("i", [self.special[m[0]]]).tobytes()]
            at = m.end()
        parts.append(self._ids(text[at:] if at else text))
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids):
        ids = ids[(ids >= 0) & (ids < len(self.offsets) - 1)]
        out = []
        for i in range(0, len(ids), CHUNK):
            part = ids[i:i + CHUNK]
            start = self.offsets[part]
            length = self.offsets[part + 1] - start
            end = np.cumsum(length)
            at = np.arange(end[-1]) + np.repeat(start - (end - length), length)
            out.append(self.blob[at].tobytes())
        return b"".join(out).decode("utf-8", "replace")


class Memo(dict):
    """Remembers what a function gave for short words or pairs. When it is full
    it becomes the older half, from which what is asked for again comes back."""

    def __init__(self, function, most):
        self.function, self.older, self.most = function, {}, most

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        if len(key) <= REMEMBERED_CHARS:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


_loaded = {}


def _vocabulary(shared):
    """The tables of a broadcast (spec, pattern, remembered), built once per worker."""
    key = shared.value
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(*key)
    return _loaded[key]


def share(spark, path, pattern, remembered=REMEMBERED):
    """Broadcast a vocabulary file and the pattern that splits texts into words.
    ``remembered`` bounds what a worker remembers, about 150 bytes an entry and six
    times as many entries; results don't depend on it."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    if len(spec) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is too large to be broadcast")
    return spark.sparkContext.broadcast((spec, pattern, remembered))


def encode(text: Column, shared) -> Column:
    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        vocabulary = _vocabulary(shared)
        ids = [vocabulary.encode(t.as_py() or "") for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        values = np.concatenate(ids) if ids else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))

    return run(text)


def decode(ids: Column, shared) -> Column:
    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        vocabulary = _vocabulary(shared)
        none = np.empty(0, np.int64)
        arrays = (x.values for x in lists)
        return pa.array(
            [vocabulary.decode(none if a is None else a.drop_null().to_numpy()) for a in arrays], pa.string()
        )

    return run(ids)


def with_tokens(df: DataFrame, shared, text="text") -> DataFrame:
    """``df`` with ``ids`` and ``decoded``."""
    return df.withColumn("ids", encode(F.col(text), shared)).withColumn("decoded", decode(F.col("ids"), shared))


def with_digests(df: DataFrame, shared, text="text", name="tokens") -> DataFrame:
    """``df`` with ``name``: the ids, and the hash of the text that they decode to. A
    worker holds one decoded text at a time, and none goes back to Spark."""

    @F.arrow_udf("struct<ids:array<int>,decoded_sha256:string>")
    def run(texts: pa.Array) -> pa.Array:
        vocabulary = _vocabulary(shared)
        values, sizes, hashes = [], [0], []
        for value in texts:
            ids = vocabulary.encode(value.as_py() or "")
            hashes.append(hashlib.sha256(vocabulary.decode(ids).encode()).hexdigest())
            values.append(ids.tobytes())
            sizes.append(len(ids))
        flat = pa.array(np.frombuffer(b"".join(values), np.int32))
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), flat)
        return pa.StructArray.from_arrays([lists, pa.array(hashes, pa.string())], names=["ids", "decoded_sha256"])

    return df.withColumn(name, run(F.col(text)))


def public_vocabulary(spark, name="byte_bpe_50k.json", remembered=REMEMBERED):
    import public_tokenizers

    return share(spark, public_tokenizers.path(name), public_tokenizers.PATTERN, remembered)


def digest(tokens: DataFrame, decoded_sha256: Column | None = None) -> DataFrame:
    return tokens.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        (F.sha2("decoded", 256) if decoded_sha256 is None else decoded_sha256).alias("decoded_sha256"),
    )


def query(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    tokens = with_digests(docs, public_vocabulary(spark)).select("doc_id", "tokens.*")
    return digest(tokens, F.col("decoded_sha256"))
