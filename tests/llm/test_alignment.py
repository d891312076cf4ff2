"""Alignment against the libraries and a plain version."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import alignment

TEXTS = [
    "The quick brown fox, isn't it?", None, "", " ", "  two  spaces \n\n\tand tabs ", "Größe über naïve façade", "日本語のテキスト 混在 text",
    "a▁b is not given back", "<s> <unk> <|endoftext|> <0x0A>", "emoji \U0001F600\U0001F468‍\U0001F469 end", "0" * 300 + "x" * 500,
    "same text", "same text", "nul \x00 byte", "  wide", "a" * 20_000, " " * 5_000, "ab12 " * 3_000,
]


@pytest.fixture(scope="module")
def shared(spark):
    return alignment.public_tokenizers(spark)


@pytest.fixture(scope="module")
def plain():
    """Token ids with their bytes, by the libraries themselves."""
    import public_tokenizers as public
    import sentencepiece
    from tokenizers import Tokenizer

    from newsloom.llm.bpe import byte_alphabet

    first = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    byte_of = {c: b for b, c in enumerate(byte_alphabet())}

    def piece(i):
        name = second.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()

    def tokens(text):
        a = first.encode(" " + text, add_special_tokens=False).ids
        a = [(i, bytes(byte_of[c] for c in first.id_to_token(i))) for i in a]
        return a, [(i, piece(i)) for i in second.encode(text)]

    return tokens


def groups_of(tokens, text):
    if not text:
        return []
    a, b = tokens(text)
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in (a, b)):
        return []

    def ends(side):
        at, out = 0, []
        for _, x in side:
            at += len(x)
            out.append(at)
        return out

    ends_a, ends_b = ends(a), ends(b)
    common, groups, last = sorted(set(ends_a) & set(ends_b)), [], 0
    for end in common:
        groups.append(([i for (i, _), e in zip(a, ends_a) if last < e <= end], [i for (i, _), e in zip(b, ends_b) if last < e <= end]))
        last = end
    return groups


def brute(tokens, texts):
    found = [groups_of(tokens, t) for t in texts]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in found]
    documents = Counter(pair for each in links for pair in each)
    most = defaultdict(int)
    for (a, _), n in documents.items():
        most[a] = max(most[a], n)
    for groups, own in zip(found, links):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        yield (
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(own.values()),
            sum(k for p, k in own.items() if documents[p] == most[p[0]]), sum(k * documents[p] for p, k in own.items()),
            hashlib.sha256(said.encode()).hexdigest() if groups else "",
        )


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def short(texts):  # the plain version is quadratic
    return [t if t is None or len(t) < 1_000 else t[:900] for t in texts]


@pytest.mark.parametrize("limit", [alignment.BROADCAST_BYTES, 0])
def test_equals_the_plain_version(spark, shared, plain, monkeypatch, limit):
    monkeypatch.setattr(alignment, "HOT_ROWS", 1)
    texts = short(TEXTS)
    docs = spark.createDataFrame([(i // 2 or None, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, measured string")
    measured = alignment.materialize(alignment.measure(docs, shared), "measured-test")
    scored = alignment.score(measured, alignment.materialize(alignment.pair_counts(measured), "counts-test"), limit)
    rows = scored.select("doc_id", "measured.*", "scored.*").collect()
    got = sorted((str(r["doc_id"]), *(r[n] for n in NAMES)) for r in rows)
    assert got == sorted((str(i // 2 or None), *want) for i, want in enumerate(brute(plain, texts)))


def test_query_equals_the_plain_version(spark, plain):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    docs = [r for r in docs if len(r["text"]) < 3_000]
    rows = {r["doc_id"]: r for r in alignment.query(spark, folder).collect()}
    for doc, want in zip(docs, brute(plain, [r["text"] for r in docs])):
        got = rows[doc["doc_id"]]
        assert tuple(got[n] for n in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")) == (*want[:4], want[6])


def test_long_texts(spark, shared):
    texts = ["ab " * 400_000, "x" * 300_000, " " * 300_000, "\n" * 100_000, "語" * 200_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in alignment.measure(docs, shared).select("doc_id", "measured.*").collect():
        assert r["n_a"] and r["n_links"] >= max(r["n_a"], r["n_b"]) >= r["n_groups"] > 0 and sum(r["times"]) == r["n_links"]


def test_slices_cover_the_same_bytes(spark, shared, plain):
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate(TEXTS[:8])], "id int, text string, alignment string")
    rows = alignment.align(docs, shared).orderBy("id").collect()
    assert list(rows[0].asDict()) == ["id", "text", "alignment"]
    for r in rows:
        got = [(r["alignment"]["a"][g["a_from"]:g["a_to"]], r["alignment"]["b"][g["b_from"]:g["b_to"]]) for g in r["alignment"]["groups"]]
        assert got == groups_of(plain, r["text"])


def test_large_groups_are_counted_by_distinct_ids(shared, monkeypatch):
    tools = alignment.Tokenizers(*shared.value)
    texts = TEXTS[4:11]
    whole = [x.tolist() for x in alignment.Chunk(tools, texts).pairs()]
    monkeypatch.setattr(alignment, "LARGE", 1)
    assert [x.tolist() for x in alignment.Chunk(tools, texts).pairs()] == whole


def test_no_rows(spark, shared):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    measured = alignment.materialize(alignment.measure(docs, shared), "none")
    for limit in (0, 1000):
        assert alignment.score(measured, alignment.pair_counts(measured), limit).count() == 0


numbers = st.lists(st.integers(0, 300), unique=True).map(sorted).map(lambda x: np.array(x, np.int64))


@settings(deadline=None)
@given(numbers, numbers)
def test_gallop_finds_all_shared_values(short, long):
    i, j = alignment.gallop(short, long)
    assert short[i].tolist() == long[j].tolist() == sorted(set(short.tolist()) & set(long.tolist()))
