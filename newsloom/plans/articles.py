"""Queries over the corpus: cleaning, profile, audit."""

from pyspark.sql import functions as F

from newsloom.operators import audit, clean, profile
from newsloom.plans.tables import (
    BLOCKED, CLEANED, CORPUS, FIRST_ROWS, WS, blocked, corpus, with_,
)
from newsloom.schemas import CORPUS_COLUMNS, EXPECTED_ROWS

# The test texts repeat a sentence at most a few times.
REPEATS = 2
CLEAN_COLUMNS = ["ord", "link", "date", "title_original", "text_original", "category", "text_len", "is_short", "is_long"]
LOOKUP = "/0[0-9a-f]*$"


def cleaned(spark, sf):
    return clean.clean(corpus(spark, sf), blocked(spark, sf))


def clean_corpus(spark, sf):
    return cleaned(spark, sf).select(*CLEAN_COLUMNS)


def clean_funnel(spark, sf):
    return clean.clean_funnel(corpus(spark, sf), blocked(spark, sf))


def corpus_profile(spark, sf):
    return profile.corpus_profile(corpus(spark, sf))


def schema_check(spark, sf):
    return profile.schema_check(corpus(spark, sf).drop("title_ukrainian", "shard"))


def flagged_short(spark, sf):
    return audit.list_rows(clean.flagged_short(cleaned(spark, sf)))


def flagged_long(spark, sf):
    return audit.list_rows(clean.flagged_long(cleaned(spark, sf)))


def audited(spark, sf):
    articles = corpus(spark, sf).select("ord", "link", "date", "text_original")
    return audit.repeat_audit(articles, repeat_threshold=REPEATS).drop("text_original")


def repeat_audit(spark, sf):
    return audited(spark, sf).withColumn("dup_ratio", F.round("dup_ratio", 6))


def repeat_top25(spark, sf):
    return audit.most_repetitive(audited(spark, sf), tie="ord").select(
        "ord", "link", "date", "text_len", F.round("dup_ratio", 6).alias("dup_ratio"),
        "max_repeat", "highly_repeated_chunks",
    )


def top_repeated_chunks(spark, sf):
    return audit.top_repeated_chunks(corpus(spark, sf), key="ord")


def threshold_sweep(spark, sf):
    return audit.threshold_sweep(audited(spark, sf))


def longest_articles(spark, sf):
    return audit.longest(corpus(spark, sf), tie="ord").select("ord", "link", "date", "text_len")


def link_lookup(spark, sf):
    found = audit.link_lookup(corpus(spark, sf), LOOKUP)
    return audit.with_text_len(found).select("ord", "link", "text_len", "text_original")


def metadata_by_category(spark, sf):
    """Articles per category and month of the cleaned corpus, as plain SQL."""
    return spark.sql(
        "SELECT category, shard AS month, count(*) AS articles, sum(text_len) AS chars "
        "FROM {article_meta} GROUP BY category, shard",
        article_meta=cleaned(spark, sf).select("category", "shard", "text_len"),
    )


QUERIES = {
    f.__name__: f
    for f in [
        clean_corpus, clean_funnel, corpus_profile, schema_check, flagged_short, flagged_long,
        repeat_audit, repeat_top25, top_repeated_chunks, threshold_sweep, longest_articles,
        link_lookup, metadata_by_category,
    ]
}

_CLEAN = with_(CORPUS, BLOCKED, FIRST_ROWS, CLEANED)

_CHUNKS = f"""pieces AS (
  SELECT ord, unnest(string_split(text_original, '.')) AS piece,
         unnest(range(len(string_split(text_original, '.')))) AS i FROM corpus),
chunks AS (
  SELECT ord, trim(piece, {WS}) AS chunk, row_number() OVER (PARTITION BY ord ORDER BY i) - 1 AS pos
  FROM pieces WHERE length(trim(piece, {WS})) > 20),
counted AS (SELECT ord, chunk, count(*) AS n, min(pos) AS first_pos FROM chunks GROUP BY ord, chunk),
stats AS (
  SELECT ord, sum(n) AS total_chunks, count(*) AS unique_chunks, count(*) / sum(n) AS dup_ratio,
         max(n) AS max_repeat, count(*) FILTER (n >= {REPEATS}) AS highly_repeated_chunks
  FROM counted GROUP BY ord),
audited AS (
  SELECT c.ord, link, date, length(text_original) AS text_len,
         CAST(coalesce(total_chunks, 0) AS BIGINT) AS total_chunks,
         CAST(coalesce(unique_chunks, 0) AS BIGINT) AS unique_chunks,
         round(coalesce(dup_ratio, 1.0), 6) AS dup_ratio,
         CAST(coalesce(max_repeat, 0) AS BIGINT) AS max_repeat,
         CAST(coalesce(highly_repeated_chunks, 0) AS BIGINT) AS highly_repeated_chunks
  FROM corpus c LEFT JOIN stats s ON c.ord = s.ord)"""

_AUDIT = with_(CORPUS, _CHUNKS)


def _filled():
    rows = []
    for c in CORPUS_COLUMNS:
        if c == "title_ukrainian":
            rows.append(f"SELECT '{c}' AS column_name, 'missing' AS kind, 0 AS filled_rows")
        else:
            rows.append(f"SELECT '{c}' AS column_name, 'expected' AS kind, count({c}) AS filled_rows FROM corpus")
    rows.append("SELECT 'ord' AS column_name, 'extra' AS kind, count(ord) AS filled_rows FROM corpus")
    return with_(CORPUS) + "\nUNION ALL ".join(rows)


_FUNNEL = [
    ("loaded", "count(*) FROM corpus"),
    ("after_known_bad", "count(*) FROM corpus WHERE link NOT IN (SELECT link FROM blocked)"),
    ("after_duplicates", "count(*) FROM first_rows"),
    ("after_blank", "count(*) FROM cleaned"),
    ("flagged_short", "count(*) FROM cleaned WHERE is_short"),
    ("flagged_long", "count(*) FROM cleaned WHERE is_long"),
]

ORACLES = {
    "clean_corpus": _CLEAN + f"SELECT {', '.join(CLEAN_COLUMNS)} FROM cleaned",
    "clean_funnel": _CLEAN + "\nUNION ALL ".join(
        f"SELECT '{stage}' AS stage, {rest.replace('count(*)', 'count(*) AS n_rows', 1)}"
        for stage, rest in _FUNNEL
    ),
    "corpus_profile": with_(CORPUS) + f"""SELECT count(*) AS n_rows, CAST({EXPECTED_ROWS} AS BIGINT) AS expected_rows,
  count(*) - count(DISTINCT link) AS duplicate_links,
  count(*) FILTER (text_original IS NULL) AS missing_texts,
  strftime(min(try_strptime(date, '%d.%m.%Y')), '%Y-%m-%d') AS first_date,
  strftime(max(try_strptime(date, '%d.%m.%Y')), '%Y-%m-%d') AS last_date,
  count(*) FILTER (try_strptime(date, '%d.%m.%Y') IS NULL) AS unparseable_dates FROM corpus""",
    "schema_check": _filled(),
    "flagged_short": _CLEAN + "SELECT link, date, title_original, text_original FROM cleaned WHERE is_short",
    "flagged_long": _CLEAN + "SELECT link, date, title_original, text_original FROM cleaned WHERE is_long",
    "repeat_audit": _AUDIT + "SELECT * FROM audited",
    "repeat_top25": _AUDIT + """SELECT ord, link, date, text_len, dup_ratio, max_repeat, highly_repeated_chunks
FROM audited ORDER BY highly_repeated_chunks DESC, ord LIMIT 25""",
    "top_repeated_chunks": _AUDIT + """SELECT ord, rank, repeats, first_pos, preview FROM (
  SELECT ord, row_number() OVER (PARTITION BY ord ORDER BY n DESC, first_pos) AS rank,
         n AS repeats, first_pos, substr(chunk, 1, 100) AS preview FROM counted) a WHERE rank <= 5""",
    "threshold_sweep": _AUDIT + """SELECT threshold,
  (SELECT count(*) FROM audited WHERE highly_repeated_chunks > threshold) AS rows_above
FROM (SELECT unnest([0, 1, 2, 5, 10, 20]) AS threshold) t""",
    "longest_articles": with_(CORPUS) + """SELECT ord, link, date, length(text_original) AS text_len
FROM corpus ORDER BY text_len DESC, ord LIMIT 10""",
    "link_lookup": with_(CORPUS) + f"""SELECT ord, link, length(text_original) AS text_len, text_original
FROM corpus WHERE regexp_matches(link, '{LOOKUP}') ORDER BY ord LIMIT 1""",
    "metadata_by_category": _CLEAN + """SELECT category, shard AS month, count(*) AS articles,
  CAST(sum(text_len) AS BIGINT) AS chars FROM cleaned GROUP BY category, shard""",
}
