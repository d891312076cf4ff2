"""Corpus profile and schema check."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import corpus_date
from newsloom.schemas import CORPUS_COLUMNS, EXPECTED_ROWS


def schema_diff(df: DataFrame, expected=None) -> list[tuple[str, str]]:
    """(kind, column) for expected columns that are missing and for extra ones."""
    expected = CORPUS_COLUMNS if expected is None else expected
    missing = sorted(set(expected) - set(df.columns))
    extra = sorted(set(df.columns) - set(expected))
    return [("missing", c) for c in missing] + [("extra", c) for c in extra]


def schema_check(df: DataFrame, expected=None) -> DataFrame:
    """One row per expected or present column: its status and how many rows
    hold a value. Advisory, nothing fails. One scan, one row per task shuffled."""
    expected = CORPUS_COLUMNS if expected is None else expected
    kinds = {c: kind for kind, c in schema_diff(df, expected)}
    columns = list(expected) + [c for c in df.columns if c not in expected]
    counts = [
        (F.count(f"`{c}`") if c in df.columns else F.lit(0).cast("bigint")).alias(f"c{i}")
        for i, c in enumerate(columns)
    ]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(kinds.get(c, "expected")).alias("kind"),
            F.col(f"c{i}").alias("filled_rows"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(F.count("*").alias("n"), *counts).select(F.inline(F.array(*rows)))


def corpus_profile(df: DataFrame) -> DataFrame:
    """One row: rows, duplicate links, missing texts, date range, bad dates.

    Metrics of absent columns are null. Everything but the duplicate count is
    carried through the per-link partial aggregate, so there is one shuffle and
    a hot link is reduced in every task first.
    """
    has = set(df.columns)
    day = corpus_date(F.col("date")) if "date" in has else F.lit(None).cast("timestamp")
    text_missing = F.col("text_original").isNull() if "text_original" in has else F.lit(None).cast("boolean")
    bad_day = day.isNull() if "date" in has else F.lit(None).cast("boolean")
    link = F.col("link") if "link" in has else F.monotonically_increasing_id()
    per_link = (
        df.select(link.alias("link"), day.alias("day"), text_missing.alias("tm"), bad_day.alias("bd"))
        .groupBy("link")
        .agg(
            F.count("*").alias("n"), F.sum(F.col("tm").cast("int")).alias("tm"),
            F.min("day").alias("lo"), F.max("day").alias("hi"),
            F.sum(F.col("bd").cast("int")).alias("bd"),
        )
    )
    duplicates = F.coalesce(F.sum(F.col("n") - 1), F.lit(0)) if "link" in has else F.lit(None).cast("bigint")
    return per_link.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.lit(EXPECTED_ROWS).cast("bigint").alias("expected_rows"),
        duplicates.alias("duplicate_links"),
        F.sum("tm").alias("missing_texts"),
        F.date_format(F.min("lo"), "yyyy-MM-dd").alias("first_date"),
        F.date_format(F.max("hi"), "yyyy-MM-dd").alias("last_date"),
        F.sum("bd").alias("unparseable_dates"),
    )
