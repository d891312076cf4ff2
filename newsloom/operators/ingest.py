"""Feed items to new articles: text, length rule, seen links, funnel."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import feed_date
from newsloom.functions.html import html_to_text
from newsloom.functions.rows import once
from newsloom.functions.text import boilerplate_cut, preview
from newsloom.operators.clean import keep_first
from newsloom.schemas import BOILERPLATE_MARKERS, MIN_CONTENT_CHARS, SHARD_COLUMNS
from newsloom.session import broadcast_if_small, fits_broadcast, materialize
from newsloom.sources.feeds import feed_entries

OUTCOMES = ["new", "no_content", "already_seen"]
ASKED = 256  # links of a batch that are looked up in the Bloom filters of stored files


def feed_articles(entries: DataFrame, markers=None, to_text=html_to_text) -> DataFrame:
    """Entries (link, title, published, category, content) as shard rows."""
    markers = BOILERPLATE_MARKERS if markers is None else markers
    texts = once(entries.withColumnRenamed("content", "_html"), "_raw", to_text(F.col("_html")))
    texts = once(texts.drop("_html"), "text_original", boilerplate_cut(F.col("_raw"), markers))
    return texts.select(
        "link",
        feed_date(F.col("published")).alias("date"),
        F.col("title").alias("title_original"),
        F.lit("").alias("title_ukrainian"),
        "text_original",
        F.lit("").alias("text_ukrainian"),
        "category",
    )


def has_content(min_chars: int = MIN_CONTENT_CHARS):
    return F.length("text_original") >= min_chars


def any_of(links) -> Column:
    """Whether the link is one of a few. Lists of up to ten values reach the Parquet
    scan as equalities, which it holds against Bloom filters; longer ones would not."""
    parts = [F.col("link").isin(links[i:i + 10]) for i in range(0, len(links), 10)] or [F.lit(False)]
    while len(parts) > 1:  # a shallow tree
        parts = [reduce(Column.__or__, parts[i:i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def seen_among(items: DataFrame, seen: DataFrame, asked: int = ASKED) -> DataFrame:
    """The links of ``items`` that are in ``seen``.

    A batch is small and the seen table only grows, so the batch's links are
    broadcast to the seen table, which is scanned without a shuffle. Up to ``asked``
    links are a filter of that scan as well, which leaves out the shards whose Bloom
    filter holds none of them. A batch too big for a broadcast is joined by shuffle;
    both sides are distinct links first, so no link can be hot.
    """
    links = materialize(items.select("link").filter("link is not null").distinct(), "batch-links")
    few = [r["link"] for r in links.limit(asked + 1).collect()]
    if len(few) <= asked:
        seen = seen.filter(any_of(few))
    if fits_broadcast(links):
        return seen.select("link").join(F.broadcast(links), "link", "left_semi").distinct()
    return links.join(seen.select("link").distinct(), "link", "left_semi")


def drop_seen(items: DataFrame, seen: DataFrame) -> DataFrame:
    known = seen_among(items, seen)
    return items.join(broadcast_if_small(known, store="known"), "link", "left_anti")


def new_articles(
    entries: DataFrame, seen: DataFrame, markers=None, min_chars=MIN_CONTENT_CHARS,
    dedupe_within_batch=False, to_text=html_to_text,
) -> DataFrame:
    """Entries that are not seen and have enough text, as shard rows.

    Seen entries are dropped by link first, so their markup is never read. Two
    entries of one link in the same pull are both kept unless
    ``dedupe_within_batch`` is set.
    """
    fresh = feed_articles(drop_seen(entries, seen), markers, to_text)
    fresh = fresh.filter(has_content(min_chars)).select(*SHARD_COLUMNS)
    if dedupe_within_batch:
        # smallest row wins, so a repeated run keeps the same one
        order = [c for c in SHARD_COLUMNS if c != "link"]
        fresh = keep_first(materialize(fresh, "fresh").distinct(), order=order)
    return fresh


def ingest_outcomes(
    entries: DataFrame, seen: DataFrame, markers=None, min_chars=MIN_CONTENT_CHARS, to_text=html_to_text,
) -> DataFrame:
    """Each entry with its outcome; the length rule is tested before the seen
    rule, so a seen item without content counts as no content."""
    known = broadcast_if_small(seen_among(entries, seen), store="known").withColumn("_seen", F.lit(True))
    outcome = (
        F.when(~F.coalesce(has_content(min_chars), F.lit(False)), "no_content")
        .when(F.col("_seen"), "already_seen")
        .otherwise("new")
    )
    articles = feed_articles(entries, markers, to_text)
    return articles.join(known, "link", "left").withColumn("outcome", outcome).drop("_seen")


def ingest_funnel(outcomes: DataFrame) -> DataFrame:
    """Fetched items and how many had each outcome, zero included."""
    counts = outcomes.agg(
        F.count("*").alias("fetched"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES],
    )
    names = ["fetched"] + OUTCOMES
    pairs = ", ".join(f"'{n}', {n}" for n in names)
    return counts.selectExpr(f"stack({len(names)}, {pairs}) as (outcome, items)")


def feed_funnel(items: DataFrame, seen: DataFrame, markers=None, min_chars=MIN_CONTENT_CHARS) -> DataFrame:
    """``ingest_funnel`` of a feed as it was read, with the items that did not parse as
    a line of their own; they count as fetched. The feed is parsed once."""
    items = materialize(items, "feed-items")
    broken = items.filter(F.col("_corrupt").isNotNull()).agg(F.count("*").alias("items"))
    broken = broken.select(F.lit("broken").alias("outcome"), "items")
    funnel = ingest_funnel(ingest_outcomes(feed_entries(items), seen, markers, min_chars)).unionByName(broken)
    total = F.when(F.col("outcome").isin("fetched", "broken"), "fetched")
    both = funnel.filter(total.isNotNull()).groupBy(total.alias("outcome")).agg(F.sum("items").alias("items"))
    return both.unionByName(funnel.filter(F.col("outcome") != "fetched"))


def feed_preview(articles: DataFrame, min_chars=MIN_CONTENT_CHARS, chars: int = 150) -> DataFrame:
    """Dry run: what would be kept, with length and opening of each text."""
    return articles.select(
        "link",
        F.col("title_original").alias("title"),
        "category",
        "date",
        F.length("text_original").alias("text_len"),
        F.when(has_content(min_chars), "ok").otherwise("skip").alias("status"),
        preview(F.col("text_original"), chars).alias("opening"),
    )


def run_summary(spark, new_count: int, embedded_shards: int) -> DataFrame:
    return spark.createDataFrame(
        [(new_count, embedded_shards)], "new_articles bigint, embedded_shards bigint"
    )
