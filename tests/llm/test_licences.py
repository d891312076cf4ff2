import pytest
from pyspark.sql import functions as F

from newsloom.llm import licences as L

SF = "/root/testdata/sf0.01"
LINES = {
    "Licensed under the Apache License, Version 2.0.": "apache",
    "All rights reserved.": "proprietary",
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Released under the MIT License.": "mit",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def classifier(docs):
    return L.train(docs)


def test_lines_of_the_table(docs, classifier):
    """Every licence line is found, and no other line is confirmed."""
    texts = {r["doc_id"]: r["text"].split("\n") for r in docs.collect()}
    rows = L.scan(docs, classifier).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = [LINES[x] for x in texts[r["doc_id"]] if x in LINES]
        assert (r["families"], r["n_confirmed"]) == (",".join(sorted(set(own))), len(own))
        assert r["n_paragraphs"] == sum(bool(x.strip()) for x in texts[r["doc_id"]])


def test_reworded_and_unknown_lines(spark, classifier):
    lines = {
        "Licensed to you under the Apache License, Version 2.0 (the License)": "apache",
        "SPDX: this program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License": "gpl",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software)": "mit",
        "The apache flew over the general's public house.": "", "He reserved all seats.": "", "license": "",
        "The rights of all were reserved for others under the law of the land.": "",
    }
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id int, text string")
    got = {r["doc_id"]: r["families"] for r in L.scan(df, classifier).collect()}
    assert [got[i] for i in range(len(lines))] == list(lines.values())


def test_edge_rows(spark, classifier):
    rows = [(None, None, "x"), (1, "", "x"), (1, " \n\t\n", "x"), (2, "All rights reserved.\n" * 500, "x"), (2, "é\n日本", "x"),
            (3, "word " * 50000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, family string")
    got = sorted(map(str, (tuple(r) for r in L.scan(df, classifier).collect())))
    assert got == sorted(map(str, [(None, 0, 0, 0, ""), (1, 0, 0, 0, ""), (1, 0, 0, 0, ""), (2, 500, 500, 500, "proprietary"),
                                   (2, 2, 0, 0, ""), (3, 1, 0, 0, "")]))


def test_empty_corpus(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    classifier = L.train(empty)
    assert L.scan(empty, classifier).collect() == []
    one = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string")
    assert L.scan(one, classifier).first()["families"] == "mit"


def test_only_spark_expressions(docs, classifier, plan_of):
    plan = plan_of(L.scan(docs, classifier))
    assert "Python" not in plan and "ArrowEval" not in plan and "Join" not in plan


def test_sure_is_a_probability(spark, classifier):
    rows = spark.createDataFrame([("released under the mit license",), ("nothing of the kind here",)], "text string")
    got = classifier.predict(rows.select(L.words_of(F.col("text")).alias("words"))).collect()
    assert 0 <= got[1]["sure"] < 0.5 < got[0]["sure"] <= 1
