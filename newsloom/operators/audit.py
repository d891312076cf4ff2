"""Audit of flagged rows: repeated sentences, longest texts, link lookup."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.rows import once
from newsloom.functions.text import chunk_stats, most_repeated, preview
from newsloom.schemas import REPEAT_THRESHOLD, SWEEP_THRESHOLDS

LISTED = ["link", "date", "title_original", "text_original"]


def list_rows(flagged: DataFrame) -> DataFrame:
    """The four fields a person reads when checking flagged rows."""
    return flagged.select(*LISTED)


def with_text_len(df: DataFrame, text: str = "text_original") -> DataFrame:
    return df.withColumn("text_len", F.length(text))


def repeat_audit(df, text="text_original", repeat_threshold=REPEAT_THRESHOLD) -> DataFrame:
    """Repetition statistics of each row's text as columns. No shuffle."""
    stats = chunk_stats(F.col(text), repeat_threshold)
    return once(with_text_len(df, text), "_s", stats).select(
        *[c for c in df.columns if c != "text_len"], "text_len", "_s.*"
    )


def most_repetitive(audited: DataFrame, top: int = 25, tie: str = "link") -> DataFrame:
    return audited.orderBy(F.desc("highly_repeated_chunks"), tie).limit(top)


def longest(df: DataFrame, top: int = 10, tie: str = "link") -> DataFrame:
    return with_text_len(df).orderBy(F.desc("text_len"), tie).limit(top)


def link_lookup(df: DataFrame, pattern: str, order: str = "ord") -> DataFrame:
    """First row whose link matches the pattern; no match gives no row."""
    return df.filter(F.col("link").rlike(pattern)).orderBy(order).limit(1)


def top_repeated_chunks(df, key="link", text="text_original", top=5, preview_chars=100) -> DataFrame:
    """The most repeated chunks of every row's text with a preview of each."""
    best = F.posexplode(most_repeated(F.col(text), top)).alias("_pos", "_b")
    return df.select(key, best).select(
        key,
        (F.col("_pos") + 1).alias("rank"),
        F.col("_b.repeats").alias("repeats"),
        F.col("_b.first_pos").alias("first_pos"),
        preview(F.col("_b.chunk"), preview_chars).alias("preview"),
    )


def threshold_sweep(df, column="highly_repeated_chunks", thresholds=None) -> DataFrame:
    """For each threshold, the rows whose value is above it, zero included."""
    thresholds = SWEEP_THRESHOLDS if thresholds is None else thresholds
    counts = df.agg(
        *[F.count_if(F.col(column) > t).alias(f"t{i}") for i, t in enumerate(thresholds)]
    )
    rows = [
        F.struct(F.lit(t).alias("threshold"), F.col(f"t{i}").alias("rows_above"))
        for i, t in enumerate(thresholds)
    ]
    return counts.select(F.inline(F.array(*rows)))
