"""Queries over feed items: text, boilerplate, ingest, manifest, shards."""

from pyspark.sql import functions as F

from newsloom.functions.html import html_to_text as to_text
from newsloom.functions.rows import once
from newsloom.functions.text import boilerplate_cut as cut
from newsloom.operators import context, embed, ingest
from newsloom.plans.tables import (
    CORPUS, SEEN, WATERMARK, corpus, entries, seen, sql_articles, sql_cut, sql_text, table, with_,
)
from newsloom.schemas import BOILERPLATE_MARKERS, SHARD_COLUMNS
from newsloom.session import materialize
from newsloom.sources import manifest, shards

# Footers of the test pages and license lines of the test documents.
PAGE_MARKERS = BOILERPLATE_MARKERS + ["©"]
TEXT_MARKERS = BOILERPLATE_MARKERS + ["Released under"]
MIN_CHARS = 1000
CONTEXT_ARTICLES = 5
DIMENSIONS = embed.HASHED_DIMENSIONS


def articles(spark, sf):
    return ingest.feed_articles(entries(spark, sf), PAGE_MARKERS)


def html_to_text(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", "url", to_text(F.col("html")).alias("text"))


def boilerplate_cut(spark, sf):
    kept = once(table(spark, sf, "documents").select("doc_id", "text"), "kept", cut(F.col("text"), TEXT_MARKERS))
    return kept.select("doc_id", "kept", F.length("kept").alias("kept_chars"))


def feed_preview(spark, sf):
    return ingest.feed_preview(articles(spark, sf), MIN_CHARS)


def rss_ingest(spark, sf):
    return ingest.new_articles(entries(spark, sf), seen(spark, sf), PAGE_MARKERS, MIN_CHARS)


def ingest_funnel(spark, sf):
    return ingest.ingest_funnel(ingest.ingest_outcomes(entries(spark, sf), seen(spark, sf), PAGE_MARKERS, MIN_CHARS))


def seen_links_build(spark, sf):
    return manifest.build_manifest(corpus(spark, sf))


def seen_links_merge(spark, sf):
    return manifest.merge_links(seen_links_build(spark, sf), seen(spark, sf))


def combined_corpus(spark, sf):
    base = corpus(spark, sf).drop("shard")
    new = rss_ingest(spark, sf).withColumn("shard", F.lit("2024-01-01T000000Z"))
    both = shards.combined(base, new)
    return both.select("link", "date", "title_original", "category", "shard", "text_original")


def _stored(spark, sf):
    """Shards that already have vectors."""
    return corpus(spark, sf).select("shard").filter(F.col("shard") < WATERMARK)


def unembedded_shards(spark, sf):
    return embed.unembedded_shards(corpus(spark, sf), _stored(spark, sf))


def _entries_of(vectors, *keys):
    """Non-zero vector entries as rows."""
    return vectors.select(*keys, F.posexplode("embedding").alias("bucket", "value")).filter("value <> 0").select(
        *keys, "bucket", F.round(F.col("value").cast("double"), 6).alias("value")
    )


def embed_hashed(spark, sf):
    documents = corpus(spark, sf).select("ord", "text_original")
    return _entries_of(embed.embed(documents), "ord")


def incremental_embed(spark, sf):
    pending = embed.incremental_embed(corpus(spark, sf), _stored(spark, sf))
    return _entries_of(pending, "link", "shard")


def rag_context(spark, sf):
    """Passages of the corpus for every benchmark question. The vectors are stored
    before the search, as the embedding job leaves them."""
    articles = corpus(spark, sf)
    embedded = embed.embed(articles.select(F.col("ord").alias("vec_id"), "text_original"))
    stored = materialize(embedded.select("vec_id", "embedding"), "article-vectors")
    questions = table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), "text")
    near = context.nearest_articles(stored, questions, CONTEXT_ARTICLES)
    return context.cited_context(near, articles)


def vector_meta_parity(spark, sf):
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("key"))
    meta = table(spark, sf, "labels").select(F.col("doc_id").alias("key"))
    return embed.vector_meta_parity(vectors, meta, "key")


QUERIES = {
    f.__name__: f
    for f in [
        html_to_text, boilerplate_cut, feed_preview, rss_ingest, ingest_funnel, seen_links_build,
        seen_links_merge, combined_corpus, unembedded_shards, embed_hashed, incremental_embed,
        vector_meta_parity, rag_context,
    ]
}

_ARTICLES = sql_articles(PAGE_MARKERS)
_NEW = f"""fresh AS (
  SELECT * FROM articles WHERE length(text_original) >= {MIN_CHARS}
    AND link NOT IN (SELECT link FROM seen))"""
_OUTCOMES = f"""outcomes AS (
  SELECT CASE WHEN length(text_original) < {MIN_CHARS} THEN 'no_content'
              WHEN link IN (SELECT link FROM seen) THEN 'already_seen' ELSE 'new' END AS outcome
  FROM articles)"""
_LINKS = "links AS (SELECT DISTINCT link FROM corpus)"

def sql_tokens(table_name, keys, text, name="entries"):
    """CTEs ending in ``name``(keys, bucket, value)."""
    return fr"""{name}_tokens AS (
  SELECT {keys}, unnest(regexp_split_to_array(lower({text}), '[\s\x0b\x1c-\x1f\x85\p{{Z}}]+')) AS w
  FROM {table_name}),
{name}_buckets AS (
  SELECT {keys}, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {DIMENSIONS} AS bucket, count(*) AS n
  FROM {name}_tokens WHERE w <> '' GROUP BY ALL),
{name}_lengths AS (SELECT {keys}, sqrt(sum(n * n)) AS norm FROM {name}_buckets GROUP BY ALL),
{name} AS (
  SELECT {', '.join('b.' + k.strip() for k in keys.split(','))}, bucket,
         CAST(CAST(n / norm AS FLOAT) AS DOUBLE) AS value
  FROM {name}_buckets b JOIN {name}_lengths USING ({keys}))"""


_RAG = f"""scored AS (
  SELECT q.item_id AS qid, d.ord,
         round(sum(q.value * d.value) / (any_value(ql.n) * any_value(dl.n)), 9) AS s
  FROM asked q JOIN entries d USING (bucket)
       JOIN (SELECT item_id, sqrt(sum(value * value)) AS n FROM asked GROUP BY item_id) ql ON ql.item_id = q.item_id
       JOIN (SELECT ord, sqrt(sum(value * value)) AS n FROM entries GROUP BY ord) dl ON dl.ord = d.ord
  GROUP BY q.item_id, d.ord),
hits AS (
  SELECT * FROM (SELECT qid, ord, row_number() OVER (PARTITION BY qid ORDER BY s DESC, ord) AS rank FROM scored) a
  WHERE rank <= {CONTEXT_ARTICLES})
SELECT qid, count(*) AS passages, string_agg('[' || rank || '] ' || title_original || ' (' || link || ')' || chr(10)
  || text_original, chr(10) || chr(10) ORDER BY rank) AS context
FROM hits JOIN corpus USING (ord) GROUP BY qid"""


ORACLES = {
    "html_to_text": f"SELECT page_id, url, {sql_text('html')} AS text FROM pages",
    "boilerplate_cut": f"""SELECT doc_id, kept, length(kept) AS kept_chars
FROM (SELECT doc_id, {sql_cut('text', TEXT_MARKERS)} AS kept FROM documents) a""",
    "feed_preview": with_(_ARTICLES) + f"""SELECT link, title_original AS title, category, date,
  length(text_original) AS text_len,
  CASE WHEN length(text_original) >= {MIN_CHARS} THEN 'ok' ELSE 'skip' END AS status,
  substr(text_original, 1, 150) AS opening FROM articles""",
    "rss_ingest": with_(_ARTICLES, SEEN, _NEW) + f"SELECT {', '.join(SHARD_COLUMNS)} FROM fresh",
    "ingest_funnel": with_(_ARTICLES, SEEN, _OUTCOMES) + "\nUNION ALL ".join(
        ["SELECT 'fetched' AS outcome, count(*) AS items FROM outcomes"]
        + [
            f"SELECT '{o}' AS outcome, count(*) AS items FROM outcomes WHERE outcome = '{o}'"
            for o in ingest.OUTCOMES
        ]
    ),
    "seen_links_build": with_(CORPUS, _LINKS) + "SELECT link FROM links",
    "seen_links_merge": with_(CORPUS, _LINKS, SEEN) + "SELECT link FROM links UNION SELECT link FROM seen",
    "combined_corpus": with_(CORPUS, _ARTICLES, SEEN, _NEW) + """SELECT link, date, title_original, category,
  'base' AS shard, text_original FROM corpus
UNION ALL SELECT link, date, title_original, category, '2024-01-01T000000Z' AS shard, text_original FROM fresh""",
    "unembedded_shards": with_(CORPUS) + f"SELECT DISTINCT shard FROM corpus WHERE shard >= '{WATERMARK}'",
    "embed_hashed": with_(CORPUS, sql_tokens("corpus", "ord", "text_original"))
    + "SELECT ord, bucket, round(value, 6) AS value FROM entries",
    "incremental_embed": with_(
        CORPUS,
        "pending AS (SELECT ord, link, shard, text_original FROM corpus"
        f" WHERE shard NOT IN (SELECT shard FROM corpus WHERE shard < '{WATERMARK}'))",
        sql_tokens("pending", "ord, link, shard", "text_original"),
    ) + "SELECT link, shard, bucket, round(value, 6) AS value FROM entries",
    "rag_context": with_(
        CORPUS, sql_tokens("corpus", "ord", "text_original"), sql_tokens("benchmark", "item_id", "text", "asked")
    ).rstrip() + ",\n" + _RAG,
    "vector_meta_parity": """SELECT (SELECT count(*) FROM embeddings) AS n_vectors,
  (SELECT count(*) FROM labels) AS n_meta,
  (SELECT count(*) FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels)) AS vectors_without_meta,
  (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)) AS meta_without_vector""",
}
