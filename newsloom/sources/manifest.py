"""The seen-links manifest: a text file or table with one link per line."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import strip


def links_of(df: DataFrame) -> DataFrame:
    """The link column only; the Parquet scan reads nothing else."""
    return df.select("link")


def normalise_links(lines: DataFrame, column: str = "link") -> DataFrame:
    """Strip, drop blank lines, keep each link once, in order of first appearance.

    Positions number the rows part by part; the least one of each link is
    aggregated before its shuffle, so a link that repeats a lot is no hot spot.
    """
    placed = lines.select(strip(F.col(column)).alias("link"), F.monotonically_increasing_id().alias("_at"))
    first = placed.filter("link <> ''").groupBy("link").agg(F.min("_at").alias("_at"))
    return first.orderBy("_at").select("link")


def read_manifest(spark, path) -> DataFrame:
    """A missing manifest raises PATH_NOT_FOUND: build it first."""
    return normalise_links(spark.read.text(path), "value")


def build_manifest(*parts: DataFrame) -> DataFrame:
    """Links of the base corpus and of every shard, each once."""
    links = links_of(parts[0])
    for part in parts[1:]:
        links = links.union(links_of(part))
    return normalise_links(links)


def merge_links(old: DataFrame, new: DataFrame) -> DataFrame:
    return links_of(old).union(links_of(new)).distinct().orderBy("link")


def write_manifest(links: DataFrame, path, mode="overwrite") -> None:
    """``overwrite`` to a fresh path or ``append``."""
    links_of(links).write.mode(mode).text(path)
