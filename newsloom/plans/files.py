"""Queries that write the given tables as files of the workload and read them back."""

import pyarrow as pa
from pyspark.sql import functions as F

from newsloom.operators import clean, embed, ingest
from newsloom.plans.feed import MIN_CHARS, PAGE_MARKERS, _ARTICLES, _NEW
from newsloom.plans.articles import ORACLES as ARTICLE_SQL
from newsloom.plans.tables import CORPUS, SEEN, blocked, corpus, entries, seen, table, with_
from newsloom.schemas import CORPUS_COLUMNS, NA_TOKENS, SHARD_COLUMNS
from newsloom.session import fresh_path, measured_bytes
from newsloom.sources import corpus as files
from newsloom.sources import feeds, manifest, shards
from newsloom.sources.vectors import read_vectors
from newsloom.streaming import ingest as job
from newsloom.streaming import log

CSV_RANGE = 1 << 18  # several ranges on the smallest tables
CSV_FILE_BYTES = 256 << 20  # of text in a CSV file, which one task writes


def write_feed(items, path, broken=None, compression="none"):
    """Entries as RSS files, as a fetch leaves them; those of the condition ``broken``
    lack an end tag. Compressed files are read as they are. Spark's XML writer knows no prefixed names, so the items are
    written as text."""

    def element(name, column):
        text = F.coalesce(F.col(column), F.lit(""))
        for char, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(char), F.lit(code))
        return F.concat(F.lit(f"<{name}>"), text, F.lit(f"</{name}>"))

    pairs = {"title": "title", "link": "link", "category": "category", "pubDate": "published", "content:encoded": "content"}
    item = F.concat(F.lit("<item>"), *[element(*pair) for pair in pairs.items()], F.lit("</item>"))
    if broken is not None:
        item = F.when(broken, F.concat(F.lit("<item><title>"), element("link", "link"), F.lit("</item>"))).otherwise(item)

    schema = pa.schema([("value", pa.string())])

    def framed(batches):
        yield pa.RecordBatch.from_arrays([pa.array(["<rss><channel>"])], schema=schema)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string())], schema=schema)
        yield pa.RecordBatch.from_arrays([pa.array(["</channel></rss>"])], schema=schema)

    # a file per task, so that each is one document
    items.select(item.alias("value")).mapInArrow(framed, "value string").write.text(path, compression=compression)


def _feed(spark, sf):
    path = fresh_path(spark, "feed")
    write_feed(entries(spark, sf), path)
    return feeds.read_feed(spark, path)


def feed_items(spark, sf):
    """Every page as a feed item, through XML."""
    found = feeds.feed_entries(_feed(spark, sf))
    return found.select("link", "title", "published", "category", F.md5("content").alias("content_md5"))


def feed_file_ingest(spark, sf):
    """New articles of a feed that was read from files."""
    return ingest.new_articles(feeds.feed_entries(_feed(spark, sf)), seen(spark, sf), PAGE_MARKERS, MIN_CHARS)


BROKEN = "length(link) % 10 = 3"


def feed_funnel(spark, sf):
    """Outcomes of a feed in which some items do not parse."""
    path = fresh_path(spark, "feed")
    write_feed(entries(spark, sf), path, F.expr(BROKEN))
    return ingest.feed_funnel(feeds.read_feed(spark, path), seen(spark, sf), PAGE_MARKERS, MIN_CHARS)


def clean_written(spark, sf):
    """The funnel that is counted while the cleaned tables are written, and their rows."""
    folder = fresh_path(spark, "cleaned")
    cleaned, funnel = clean.clean_observed(corpus(spark, sf), blocked(spark, sf))
    files.write_cleaned(cleaned, folder)
    rows = funnel()
    for name in ("cleaned", "flagged_short", "flagged_long"):
        count = spark.read.parquet(f"{folder}/{name}").agg(F.count("*").alias("n_rows"))
        rows = rows.unionByName(count.select(F.lit(f"rows of {name}").alias("stage"), "n_rows"))
    return rows


def csv_corpus(spark, sf):
    """The corpus exported as CSV and landed again."""
    path = fresh_path(spark, "csv")
    files.write_csv(corpus(spark, sf), path, CORPUS_COLUMNS)
    return _hashed(files.land(spark, path, fresh_path(spark, "landed")))


def csv_ranges(spark, sf):
    """The corpus as a single CSV file, landed by many tasks. A corpus that is more than
    one task should write is several such files, each of many ranges."""
    path = fresh_path(spark, "csv")
    n_files = max(1, -(-measured_bytes(table(spark, sf, "documents")) // CSV_FILE_BYTES))
    files.write_csv(corpus(spark, sf).coalesce(n_files), path, CORPUS_COLUMNS)
    return _hashed(files.land(spark, path, fresh_path(spark, "landed"), range_bytes=CSV_RANGE))


def _hashed(back):
    return back.select(*[F.md5(c).alias(c) if c.startswith("text") or c.startswith("title") else F.col(c) for c in CORPUS_COLUMNS])


def manifest_file(spark, sf):
    """The manifest of the corpus and the seen pages, written and read."""
    path = fresh_path(spark, "manifest")
    manifest.write_manifest(manifest.build_manifest(corpus(spark, sf), seen(spark, sf)), path)
    return manifest.read_manifest(spark, path)


def shard_vectors(spark, sf):
    """Vectors of all shards: half of them first, the rest by the backlog job."""
    home, vectors = fresh_path(spark, "shards"), fresh_path(spark, "vectors")
    rows = corpus(spark, sf).select(*SHARD_COLUMNS, "shard")
    rows.write.partitionBy("shard").parquet(home)
    early = shards.read_shards(spark, home).filter("shard < '2023'")
    embed.write_vectors(embed.vectors_of(early), vectors)
    embed.embed_backlog(spark, home, vectors)
    found = read_vectors(spark, vectors)
    sums = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    return found.select("link", "shard", F.round(sums, 3).alias("norm")).groupBy("shard").agg(
        F.count("*").alias("n"), F.count_distinct("link").alias("links"), F.min("norm").alias("least"), F.max("norm").alias("most"))


def positional_join(spark, sf):
    """Vectors and pages tied only by their place."""
    vectors = table(spark, sf, "embeddings").select("vec_id", "label")
    meta = vectors.select(F.col("vec_id").alias("meta_id"))
    joined = embed.join_by_position(vectors, meta.orderBy(F.desc("meta_id")), ["vec_id"], ["meta_id"])
    return joined.select("position", "vec_id", "label", "meta_id")


def stored_positions(spark, sf):
    """The same for tables that were written in their order: places come from the files."""
    paths = [fresh_path(spark, name) for name in ("ordered-vectors", "ordered-meta")]
    vectors = table(spark, sf, "embeddings").select("vec_id", "label").orderBy("vec_id")
    vectors.write.parquet(paths[0])
    vectors.select(F.col("vec_id").alias("meta_id")).write.parquet(paths[1])
    return embed.join_stored(spark, *paths).select("position", "vec_id", "label", "meta_id")


def scheduled_ingest(spark, sf):
    """Two scheduled runs: the pages in two snapshots, then shards and vectors."""
    home = fresh_path(spark, "scheduled")
    feed = entries(spark, sf)
    early = F.length("link") % 2 == 0
    known = seen(spark, sf)
    out = None
    for run, part in enumerate((early, ~early), 1):
        write_feed(feed.filter(part), f"{home}/feed/{run}")
        summary = job.run_once(
            spark, f"{home}/feed/*", known, f"{home}/shards", f"{home}/vectors", f"{home}/checkpoint",
            markers=PAGE_MARKERS, min_chars=MIN_CHARS,
        ).select(F.lit(run).alias("run"), "new_articles", "embedded_shards")
        out = summary if out is None else out.unionByName(summary)
    return out


UNFINISHED = "length(link) % 3 = 0"


def ingest_state(spark, sf):
    """Three runs whose state shows: items without text come back finished, the first batch
    is replayed, the second run's shard is lost and comes back from an unchanged feed."""
    home = fresh_path(spark, "state")
    paths = [f"{home}/{name}" for name in ("shards", "vectors", "checkpoint")]
    feed, known, rules = entries(spark, sf), seen(spark, sf), {"markers": PAGE_MARKERS, "min_chars": MIN_CHARS}
    unfinished = F.when(F.expr(UNFINISHED), F.lit("")).otherwise(F.col("content"))
    out = None
    for run in (1, 2, 3):
        lost = log.lost_articles(spark, paths[2], paths[0]).agg(
            F.coalesce(F.sum(F.col("new_articles") - F.col("stored")), F.lit(0)).alias("lost")).first()["lost"]
        snapshot = feed.withColumn("content", unfinished) if run == 1 else feed
        write_feed(snapshot, f"{home}/feed/{run}", compression="gzip")
        summary = job.run_once(spark, f"{home}/feed/*", known, *paths, **rules)
        if run == 2:
            job.ingest_batch(feeds.read_feed(spark, f"{home}/feed/1"), 0, known, paths[0], **rules, checkpoint=paths[2])
            for row in log.batches(spark, paths[2]).filter("batch = 1").collect():
                shards._drop_shard(spark, paths[0], row["shard"])
        row = summary.select(F.lit(run).alias("run"), "new_articles", "embedded_shards", F.lit(lost).cast("bigint").alias("lost_before"))
        out = row if out is None else out.unionByName(row)
    stored = shards.read_shards(spark, paths[0]).agg(F.count("*").alias("stored"), F.count_distinct("link").alias("links"))
    return out.crossJoin(F.broadcast(stored))  # one row on the right


QUERIES = {
    f.__name__: f
    for f in [feed_items, feed_file_ingest, feed_funnel, clean_written, csv_corpus, csv_ranges, manifest_file, shard_vectors, positional_join, stored_positions, scheduled_ingest, ingest_state]
}

_TOKENS = ", ".join("'" + t + "'" for t in NA_TOKENS)


def _read(column, name):
    return f"CASE WHEN {column} IN ({_TOKENS}) THEN NULL ELSE {column} END AS {name}"


_HASHED = ", ".join(
    f"md5({c}) AS {c}" if c.startswith("text") or c.startswith("title") else c for c in CORPUS_COLUMNS
)
ORACLES = {
    "feed_items": """SELECT url AS link, trim(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is')) AS title,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((page_id % 1000000) * 37 AS INTEGER)), '%a, %d %b %Y %H:%M:%S') || ' +0300' AS published,
  regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS category, md5(html) AS content_md5 FROM pages""",
    "feed_file_ingest": with_(_ARTICLES, SEEN, _NEW) + "SELECT " + ", ".join(
        "trim(title_original) AS title_original" if c == "title_original" else c for c in SHARD_COLUMNS) + " FROM fresh",
    "feed_funnel": with_(_ARTICLES, SEEN, f"""outcomes AS (
  SELECT CASE WHEN {BROKEN} THEN 'broken' WHEN length(text_original) < {MIN_CHARS} THEN 'no_content'
              WHEN link IN (SELECT link FROM seen) THEN 'already_seen' ELSE 'new' END AS outcome
  FROM articles)""") + "\nUNION ALL ".join(
        ["SELECT 'fetched' AS outcome, count(*) AS items FROM outcomes"]
        + [f"SELECT '{o}' AS outcome, count(*) AS items FROM outcomes WHERE outcome = '{o}'" for o in [*ingest.OUTCOMES, "broken"]]),
    "clean_written": f"""WITH funnel AS ({ARTICLE_SQL['clean_funnel']})
SELECT stage, n_rows FROM funnel UNION ALL
SELECT CASE stage WHEN 'after_blank' THEN 'rows of cleaned' ELSE 'rows of ' || stage END AS stage, n_rows
FROM funnel WHERE stage IN ('after_blank', 'flagged_short', 'flagged_long')""",
    "csv_corpus": with_(CORPUS) + f"SELECT {_HASHED} FROM (SELECT " + ", ".join(_read(c, c) for c in CORPUS_COLUMNS) + " FROM corpus) a",
    "csv_ranges": with_(CORPUS) + f"SELECT {_HASHED} FROM (SELECT " + ", ".join(_read(c, c) for c in CORPUS_COLUMNS) + " FROM corpus) a",
    "manifest_file": with_(CORPUS, SEEN) + "SELECT link FROM corpus UNION SELECT link FROM seen",
    "shard_vectors": with_(CORPUS) + """SELECT shard, count(*) AS n, count(DISTINCT link) AS links,
  min(CASE WHEN trim(text_original) = '' THEN 0.0 ELSE 1.0 END)::DOUBLE AS least,
  max(CASE WHEN trim(text_original) = '' THEN 0.0 ELSE 1.0 END)::DOUBLE AS most FROM corpus GROUP BY shard""",
    "scheduled_ingest": with_(_ARTICLES, SEEN, _NEW) + """SELECT run, n AS new_articles, CAST(n > 0 AS BIGINT) AS embedded_shards
FROM (SELECT CAST(r AS INTEGER) AS run, count(DISTINCT link) AS n FROM range(1, 3) t(r)
  LEFT JOIN fresh ON length(link) % 2 = r - 1 GROUP BY r) a""",
    "ingest_state": with_(_ARTICLES, SEEN, _NEW, f"""counts AS (
  SELECT count(DISTINCT link) AS n, count(DISTINCT CASE WHEN {UNFINISHED} THEN link END) AS late FROM fresh)""")
    + """SELECT CAST(r AS INTEGER) AS run, CASE r WHEN 1 THEN n - late ELSE late END AS new_articles,
  CAST(CASE r WHEN 1 THEN n - late ELSE late END > 0 AS BIGINT) AS embedded_shards,
  CASE r WHEN 3 THEN late ELSE 0 END AS lost_before, n AS stored, n AS links FROM range(1, 4) t(r), counts""",
    "stored_positions": "SELECT row_number() OVER (ORDER BY vec_id) - 1 AS position, vec_id, label, vec_id AS meta_id FROM embeddings",
    "positional_join": """SELECT row_number() OVER (ORDER BY vec_id) - 1 AS position, vec_id, label, vec_id AS meta_id FROM embeddings""",
}
