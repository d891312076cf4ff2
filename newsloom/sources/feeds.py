"""Landed feed snapshots (RSS XML) as batch or stream."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEED_SCHEMA = (
    "title string, link string, category array<string>, pubDate string, "
    "`content:encoded` array<string>, _corrupt string"
)


END = "</item>"
PARSING = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def _items(pieces: DataFrame) -> DataFrame:
    """The items of a feed that was split at their end tags, with the time at which
    the snapshot landed; it names the ingest run.

    Each item is parsed by itself, so that one that is broken costs no other.
    """
    item = F.regexp_extract("value", r"(?s)<item[\s>].*", 0)
    items = pieces.select(item.alias("item"), F.col("_metadata.file_modification_time").alias("landed")).filter("item <> ''")
    parsed = F.from_xml(F.concat("item", F.lit(END)), FEED_SCHEMA, PARSING)
    return items.select(parsed.alias("_item"), "landed").select("_item.*", "landed")


def read_feed(spark, path) -> DataFrame:
    return _items(spark.read.option("lineSep", END).text(path))


def stream_feed(spark, path, max_files=None) -> DataFrame:
    reader = spark.readStream.option("lineSep", END)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _items(reader.text(path))


def _text(c) -> Column:
    return F.coalesce(c, F.lit(""))


def feed_entries(items: DataFrame) -> DataFrame:
    """Item fields with their defaults: first body and first category or ''."""
    good = items.filter(F.col("_corrupt").isNull()) if "_corrupt" in items.columns else items
    return good.select(
        F.trim("link").alias("link"),
        _text(F.trim("title")).alias("title"),
        F.col("pubDate").alias("published"),
        _text(F.get("category", F.lit(0))).alias("category"),
        _text(F.get("content:encoded", F.lit(0))).alias("content"),
        "landed",
    )


def broken_items(items: DataFrame) -> DataFrame:
    """One row (linked_items, broken_items): items with a link, and items that did
    not parse, which are reported and not fatal."""
    return items.agg(
        F.count("link").alias("linked_items"),
        F.count_if(F.col("_corrupt").isNotNull()).alias("broken_items"),
    )
