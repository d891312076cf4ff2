"""Licence notices in paragraphs. DataFrame expressions and Spark's own
classifier only.

A paragraph is a line. A multinomial logistic regression over its word and
word-pair hashes tells licence families from the class ``unknown``. It is
trained on the templates below, whole and with words left out, and on a bounded
sample of corpus paragraphs that share less than half of their words with any
template. How sure a prediction is, is calibrated on paragraphs that the
regression did not see; a paragraph below ``SURE`` is unknown. A prediction is
confirmed if the paragraph holds at least ``SAME`` of the distinct words and
word pairs of one template of that family.

Texts are read once; what leaves a row are counts and a bit per family.

Defined cases: null and empty texts have no paragraph, and white-space lines are
none; repeated rows are each reported; null ids are kept; an empty corpus is
never scanned and its classifier knows the templates only; further columns are
ignored.
"""

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import materialize

# How common licences are announced or begin, in lower case.
TEMPLATES = {
    "agpl": [
        "licensed under the gnu affero general public license version 3",
        "you should have received a copy of the gnu affero general public license along with this program",
    ],
    "apache": [
        "licensed under the apache license version 2.0",
        "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license",
        "released under the apache 2.0 license",
    ],
    "bsd": [
        "licensed under the bsd 3-clause license",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "use of this source code is governed by a bsd-style license",
    ],
    "cc-by": ["licensed under cc by 4.0", "this work is licensed under a creative commons attribution 4.0 international license"],
    "cc-by-nc": [
        "licensed under cc by-nc 4.0",
        "this work is licensed under a creative commons attribution-noncommercial 4.0 international license",
    ],
    "cc-by-sa": [
        "licensed under cc by-sa 4.0",
        "this work is licensed under a creative commons attribution-sharealike 4.0 international license",
    ],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 2",
        "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license",
    ],
    "lgpl": ["licensed under the gnu lesser general public license version 2.1"],
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    ],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v. 2.0"],
    "proprietary": ["all rights reserved", "confidential and proprietary all rights reserved"],
    "public-domain": ["this work is released into the public domain", "to the extent possible under law all copyright has been waived cc0 1.0"],
}
FAMILIES = sorted(TEMPLATES)
UNKNOWN = len(FAMILIES)

SAMPLE = 3000  # corpus paragraphs that train the unknown class, the least by hash
FEATURES = 1 << 13
SURE = 0.5
SAME = 0.8
EDITS = 6  # training variants of a template with words left out


def words_of(line: Column) -> Column:
    """Words in lower case: letters, digits and what may join them inside."""
    return F.regexp_extract_all(F.lower(line), F.lit(r"[a-z0-9]+(?:[./-][a-z0-9]+)*"), F.lit(0))


def n_grams(words: Column) -> Column:
    """Words and pairs of neighbours."""
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))),
                       lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(words, F.slice(pairs, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))))


def _templates(spark) -> DataFrame:
    rows = [(k, text) for k, family in enumerate(FAMILIES) for text in TEMPLATES[family]]
    return spark.createDataFrame(rows, "label int, text string").select("label", words_of(F.col("text")).alias("words"))


def _literal(words) -> Column:
    return F.array(*[F.lit(w) for w in sorted(set(words))])


def _template_grams(text):
    words = text.split()
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def _shares(words: Column, templates: Column) -> Column:
    """The share of each template's distinct words (or n-grams) that a paragraph holds."""
    return F.transform(templates, lambda t: F.size(F.array_intersect(words, t)) / F.size(t))


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.rlike(line, F.lit(r"\S")))


def training_rows(docs: DataFrame, text="text") -> DataFrame:
    """(label, words, fold) of templates, their variants and unknown paragraphs."""
    spark = docs.sparkSession
    templates = _templates(spark)
    # every variant leaves out each word whose place has the same remainder
    kept = F.filter("words", lambda w, i: (i + F.col("v")) % (EDITS + 1) != 0)
    variants = templates.select("label", "words", F.explode(F.sequence(F.lit(0), F.lit(EDITS))).alias("v"))
    variants = variants.select("label", F.when(F.col("v") < F.size("words"), kept).otherwise(F.col("words")).alias("words"))
    variants = variants.filter(F.size("words") > 1).unionByName(templates)
    lines = docs.select(F.explode(paragraphs(F.col(text))).alias("line")).select(
        "line", F.xxhash64("line").alias("at")
    ).orderBy("at", "line").limit(SAMPLE)
    plain = lines.select(words_of(F.col("line")).alias("words"))
    every = F.array(*[_literal(t.split()) for family in FAMILIES for t in TEMPLATES[family]])
    most = F.array_max(_shares(F.col("words"), every))
    plain = plain.filter((F.size("words") > 0) & (most < 0.5))
    # parts of templates are no licence
    halves = templates.select(F.explode(F.array(
        F.slice("words", F.lit(1), F.greatest(F.floor(F.size("words") / 3).cast("int"), F.lit(1))),
        F.slice("words", F.greatest(F.floor(F.size("words") * 2 / 3).cast("int") + 1, F.lit(1)), F.size("words")),
    )).alias("words")).filter(F.size("words") < 4)
    others = plain.unionByName(halves).select(F.lit(UNKNOWN).alias("label"), "words")
    rows = variants.unionByName(others).select("label", "words")
    return rows.withColumn("fold", F.pmod(F.xxhash64("label", "words"), F.lit(5)))


def _vectors(rows: DataFrame, words="words", out="features") -> DataFrame:
    """``rows`` with hashed n-gram flags."""
    hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol=out)
    return hashing.transform(rows.withColumn("_grams", n_grams(F.col(words)))).drop("_grams")


class Classifier:
    """The regression and the calibration of how sure it is."""

    def __init__(self, model, slope, offset):
        self.model, self.slope, self.offset = model, slope, offset

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``words``) with ``family`` (a number; UNKNOWN if below
        SURE) and ``sure``."""
        scored = _margins(self.model.transform(_vectors(rows)))
        sure = 1 / (1 + F.exp(-(F.lit(self.slope) * F.col("margin") + F.lit(self.offset))))
        scored = scored.withColumn("sure", sure)
        family = F.when(F.col("sure") >= SURE, F.col("best")).otherwise(F.lit(UNKNOWN))
        return scored.withColumn("family", family).drop("margin", "best")


def _margins(predicted: DataFrame) -> DataFrame:
    """The best licence family and its logit less that of the unknown class."""
    raw = predicted.withColumn("_raw", vector_to_array("rawPrediction")).drop(
        "rawPrediction", "probability", "prediction", "features")
    licences = F.slice("_raw", 1, UNKNOWN)
    top = F.array_max(licences)
    return raw.withColumn("best", (F.array_position(licences, top) - 1).cast("int")).withColumn(
        "margin", top - F.get("_raw", F.lit(UNKNOWN))).drop("_raw")


def train(docs: DataFrame, text="text") -> Classifier:
    rows = materialize(training_rows(docs, text), "licence-training")
    regression = LogisticRegression(maxIter=60, regParam=0.001, family="multinomial")
    # a few thousand rows, whatever the corpus: one task
    labelled = _vectors(rows.coalesce(1).withColumn("label", F.col("label").cast("double"))).cache()
    # held-out margins come from a regression without that fold
    first = regression.fit(labelled.filter("fold <> 0"))
    held = _margins(first.transform(labelled.filter("fold = 0")))
    known = (F.col("label") < UNKNOWN).cast("int")
    right = known * (F.col("label") == F.col("best")).cast("int")
    margins = held.select(right.alias("right"), "margin").groupBy("right").agg(
        F.avg("margin").alias("mean"), F.stddev_pop("margin").alias("dev"), F.count("*").alias("n")).collect()
    slope, offset = _calibration({r["right"]: r for r in margins})
    model = regression.fit(labelled)
    labelled.unpersist()
    return Classifier(model, slope, offset)


def _calibration(found):
    """The logistic curve through two normal margin distributions of one pooled
    spread; the plain logit where one of them is missing."""
    if len(found) < 2:
        return 1.0, 0.0
    spread = sum(r["n"] * r["dev"] ** 2 for r in found.values()) / sum(r["n"] for r in found.values())
    low, high = found[0]["mean"], found[1]["mean"]
    if high <= low:
        return 1.0, 0.0
    slope = (high - low) / max(spread, 1.0)
    return slope, -slope * (high + low) / 2


def scan(docs: DataFrame, classifier: Classifier, doc="doc_id", text="text") -> DataFrame:
    """Per document: ``n_paragraphs``, ``n_predicted``, ``n_confirmed`` and the
    confirmed ``families``, sorted and joined by commas."""
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), doc, text)
    lines = numbered.select("_row", doc, F.explode_outer(paragraphs(F.col(text))).alias("line"))
    words = F.coalesce(words_of(F.col("line")), F.array().cast("array<string>"))
    rows = classifier.predict(lines.select("_row", doc, F.col("line").isNotNull().alias("is_line"), words.alias("words")))
    grams = n_grams(F.col("words"))
    shares = {
        k: F.array_max(_shares(grams, F.array(*[_literal(_template_grams(t)) for t in TEMPLATES[family]])))
        for k, family in enumerate(FAMILIES)
    }
    same = reduce(lambda rest, k: rest.when(F.col("family") == k, shares[k] >= SAME), shares, F.when(F.lit(False), F.lit(False)))
    licensed = F.col("is_line") & (F.col("family") < UNKNOWN)
    marked = rows.select(
        "_row", doc, "is_line", licensed.alias("licensed"), "family",
        F.when(licensed, same).otherwise(F.lit(False)).alias("confirmed"),
    )
    bits = F.bit_or(F.when(F.col("confirmed"), F.expr("shiftleft(1L, family)")).otherwise(F.lit(0).cast("bigint")))
    found = marked.groupBy("_row").agg(
        F.first(doc).alias(doc), F.count_if("is_line").alias("n_paragraphs"),
        F.count_if("licensed").alias("n_predicted"), F.count_if("confirmed").alias("n_confirmed"), bits.alias("_bits"),
    )
    families = F.array_compact(F.array(*[
        F.when(F.col("_bits").bitwiseAND(F.lit(1 << k)) != 0, F.lit(f)) for k, f in enumerate(FAMILIES)]))
    return found.select(doc, "n_paragraphs", "n_predicted", "n_confirmed", F.array_join(families, ",").alias("families"))


def query(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs, train(docs))
