"""The generated test tables seen as the tables of the workload.

Each view exists twice, as a DataFrame and as a SQL common table expression.
"""

from pyspark.sql import functions as F

from newsloom.schemas import WHITESPACE

WS = "'" + WHITESPACE + "'"
FIRST_DAY = "2022-02-24"
SEEN_PREFIX = "https:"
# Shards before this month count as embedded already.
WATERMARK = "2022-06"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark, sf_dir):
    """documents as articles: copies of a text share a link."""
    day = F.expr(f"date_add(date'{FIRST_DAY}', cast(doc_id % 1200 as int))")
    null = F.lit(None).cast("string")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"),
        F.concat(F.lit("https://example/"), F.md5("text")).alias("link"),
        F.date_format(day, "dd.MM.yyyy").alias("date"),
        F.substring_index("text", "\n", 1).alias("title_original"),
        F.col("text").alias("text_original"),
        null.alias("title_ukrainian"),
        null.alias("text_ukrainian"),
        F.col("source").alias("category"),
        F.date_format(day, "yyyy-MM").alias("shard"),
    )


CORPUS = f"""corpus AS (
  SELECT doc_id AS ord, 'https://example/' || md5(text) AS link,
         strftime(DATE '{FIRST_DAY}' + CAST(doc_id % 1200 AS INTEGER), '%d.%m.%Y') AS date,
         split_part(text, chr(10), 1) AS title_original, text AS text_original,
         CAST(NULL AS VARCHAR) AS title_ukrainian, CAST(NULL AS VARCHAR) AS text_ukrainian,
         source AS category,
         strftime(DATE '{FIRST_DAY}' + CAST(doc_id % 1200 AS INTEGER), '%Y-%m') AS shard
  FROM documents)"""


def blocked(spark, sf_dir):
    """Known-bad links: the documents that are labelled toxic."""
    bad = table(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").alias("ord"))
    return corpus(spark, sf_dir).join(bad, "ord", "left_semi").select("link")


BLOCKED = """blocked AS (
  SELECT DISTINCT 'https://example/' || md5(text) AS link
  FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)"""

FIRST_ROWS = """first_rows AS (
  SELECT * FROM corpus WHERE link NOT IN (SELECT link FROM blocked)
  QUALIFY row_number() OVER (PARTITION BY link ORDER BY ord) = 1)"""

CLEANED = f"""cleaned AS (
  SELECT *, length(text_original) AS text_len, length(text_original) < 100 AS is_short,
         length(text_original) > 20000 AS is_long
  FROM first_rows WHERE trim(text_original, {WS}) <> '')"""


def entries(spark, sf_dir):
    """pages as feed items, published in a zone three hours ahead of UTC."""
    wall = F.expr(
        "timestampadd(MINUTE, cast(page_id % 1000000 as int) * 37, timestamp_ntz'2024-01-01 00:00:00')"
    )
    return table(spark, sf_dir, "pages").select(
        F.col("url").alias("link"),
        F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("title"),
        F.concat(F.date_format(wall, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0300")).alias("published"),
        F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1).alias("category"),
        F.col("html").alias("content"),
    )


def seen(spark, sf_dir):
    """Links that were ingested before: the pages under https."""
    return table(spark, sf_dir, "pages").select(F.col("url").alias("link")).filter(
        F.startswith("link", F.lit(SEEN_PREFIX))
    )


def sql_text(column):
    """SQL of the HTML-to-text rule for the entities that the pages hold."""
    raw = column
    for tag in ["script", "style", "template", "rt", "rp"]:
        raw = f"regexp_replace({raw}, '<{tag}\\b[^>]*>.*?</{tag}\\s*>', chr(64976), 'gis')"
    raw = f"regexp_replace({raw}, '<!--.*?-->', chr(64976), 'gs')"
    raw = f"regexp_replace({raw}, '<[A-Za-z/!?][^>]*>', chr(64976), 'g')"
    # a reference may lack its semicolon; &amp; is set aside so that it is read once
    held = "chr(64977)"
    names = [("amp", held)] + [
        (name, f"chr({code})")
        for name, code in [("copy", 169), ("middot", 183), ("nbsp", 160), ("quot", 34), ("#39", 39), ("lt", 60), ("gt", 62)]
    ]
    for name, char in names:
        raw = f"replace({raw}, '&{name};', {char})"
        raw = f"regexp_replace({raw}, '&{name}([^a-zA-Z0-9]|$)', {char} || '\\1', 'g')"
    raw = f"replace({raw}, {held}, '&')"
    nodes = f"list_transform(string_split({raw}, chr(64976)), lambda n: trim(n, {WS}))"
    return f"array_to_string(list_filter({nodes}, lambda n: n <> ''), ' ')"


def sql_cut(column, markers):
    """SQL of the boilerplate cut."""
    found = [f"nullif(strpos(lower({column}), '{m.lower()}'), 0)" for m in markers]
    at = f"least({', '.join(found)})"
    return f"CASE WHEN {at} IS NULL THEN {column} ELSE rtrim(substr({column}, 1, {at} - 1), {WS}) END"


def sql_articles(markers):
    return f"""raw_articles AS (
  SELECT url AS link,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((page_id % 1000000) * 37 AS INTEGER))
                  - INTERVAL 3 HOUR, '%d.%m.%Y') AS date,
         regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is') AS title_original,
         {sql_text('html')} AS raw_text,
         regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS category
  FROM pages),
articles AS (
  SELECT link, date, title_original, '' AS title_ukrainian, {sql_cut('raw_text', markers)} AS text_original,
         '' AS text_ukrainian, category
  FROM raw_articles)"""


SEEN = f"seen AS (SELECT url AS link FROM pages WHERE starts_with(url, '{SEEN_PREFIX}'))"

UNIT = """unit AS (
  SELECT vec_id, list_transform(e, lambda x: CASE WHEN n > 0 THEN x / n ELSE 0.0 END) AS u
  FROM (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) a) b)"""

POSITIONED = """positioned AS (
  SELECT vec_id, row_number() OVER (ORDER BY md5('42:' || vec_id), vec_id) AS pos FROM embeddings)"""

NLIST = """nlist AS (
  SELECT greatest(1, least(CAST(floor(4 * sqrt(count(*))) AS BIGINT), greatest(1, count(*) // 40))) AS n
  FROM embeddings)"""

CENTRES = """nodes AS (SELECT min(vec_id) AS vec_id FROM embeddings GROUP BY embedding),
centres AS (
  SELECT vec_id AS cell, u FROM unit SEMI JOIN (
    SELECT vec_id FROM (
      SELECT vec_id, row_number() OVER (ORDER BY md5('42:cell:' || vec_id), vec_id) AS r FROM nodes) a
    WHERE r <= (SELECT n FROM nlist)) picked USING (vec_id))"""

NEAR = """near AS (
  SELECT vec_id, cell, row_number() OVER (
           PARTITION BY vec_id ORDER BY round(list_inner_product(v.u, c.u), 9) DESC, cell) AS r
  FROM unit v, centres c)"""


def sql_queries(n_queries, smallest=None):
    where = f"WHERE pos <= {smallest}" if smallest else ""
    return f"""queries AS (
  SELECT vec_id AS qid FROM (
    SELECT vec_id, row_number() OVER (ORDER BY md5('42:query:' || vec_id), vec_id) AS r
    FROM positioned {where}) a
  WHERE r <= {n_queries})"""


def with_(*parts):
    return "WITH " + ",\n".join(parts) + "\n"
