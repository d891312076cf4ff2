import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read(), public_tokenizers.PATTERN)


TRICKY = ["", " ", "\n", "a", "  a  b ", "a\n\nb", "a \nb", "it's we'll I'D", "x<|endoftext|>y<|endoftext|>", "<|endoftext",
          "\x00\x1c\x85\xa0 \u2028é", "１２３ ½ ²", "\U0001f600\U0001f600 z", "a" * 3000, "ab" * 2000 + " " * 500, "\r\n\t x"]


def test_equals_the_library(library, vocabulary):
    rng = random.Random(5)
    texts = TRICKY + ["".join(rng.choice("abe tn\n'.,sé1 ") for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = vocabulary.encode(text)
        assert ids.tolist() == want.ids, repr(text)
        assert vocabulary.decode(ids) == text


def test_every_token_of_the_vocabulary(library, vocabulary):
    texts = [library.decode([i], skip_special_tokens=False) for i in range(50257)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert vocabulary.encode(text).tolist() == want.ids


def test_full_memo_changes_nothing(vocabulary, monkeypatch):
    texts = [f"word{i} and{i % 7}, é{i}" for i in range(200)]
    want = [vocabulary.encode(t).tolist() for t in texts]
    for memo in (vocabulary.plain, vocabulary.spaced, vocabulary.joins):
        memo.clear()
        memo.older = {}
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    assert [vocabulary.encode(t).tolist() for t in texts] == want


def test_columns_nulls_and_repeats(spark, library):
    texts = [None, "", "to be", "to be", "x" * 10000, *TRICKY]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, other string")
    rows = bpe.with_tokens(df, bpe.public_vocabulary(spark)).orderBy("doc_id").collect()
    assert [r["ids"] for r in rows] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [r["decoded"] for r in rows] == [t or "" for t in texts] and rows[0]["text"] is None
    ids = spark.createDataFrame([([72, None, 99999, -1, 50256],), (None,), ([],)], "ids array<int>")
    back = [r[0] for r in ids.select(bpe.decode(F.col("ids"), bpe.public_vocabulary(spark))).collect()]
    assert back == [library.decode([72, 50256], skip_special_tokens=False), "", ""]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digest(bpe.with_tokens(df, bpe.public_vocabulary(spark))).collect() == []


def test_query_equals_the_library(spark, library):
    import hashlib

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = bpe.query(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_digests_equal_the_decoded_texts(spark):
    """Also with a memory of few words."""
    texts = [None, "", "one two two", "Größe \U0001F600 <|endoftext|> x", "a" * 5_000, "one two two"]
    docs = spark.createDataFrame([(i // 2, t, 1) for i, t in enumerate(texts)], "doc_id int, text string, ids int")
    few = bpe.with_digests(docs, bpe.public_vocabulary(spark, remembered=3))
    got = few.select("doc_id", "ids", "tokens.ids", "tokens.decoded_sha256")
    whole = bpe.with_tokens(docs.drop("ids"), bpe.public_vocabulary(spark))
    want = whole.select("doc_id", bpe.F.lit(1), "ids", bpe.F.sha2("decoded", 256))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_the_query_sends_each_text_to_python_once(spark, plan_of):
    """A decoder on top of the encoder's column ran the encoder twice, once for each column."""
    got = bpe.query(spark, "/root/testdata/sf0.001")
    assert "run(text" in plan_of(got) and "run(run(" not in plan_of(got)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = bpe.digest(bpe.with_tokens(docs, bpe.public_vocabulary(spark)))
    assert "run(run(" in plan_of(want)
    assert sorted(got.collect()) == sorted(want.collect())
