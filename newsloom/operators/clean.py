"""Corpus cleaning: blocklist, keep-first by link, blank text, length flags."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.functions.text import is_blank
from newsloom.schemas import KNOWN_BAD_LINKS, LONG_CHARS, SHORT_CHARS
from newsloom.session import BROADCAST_BYTES, broadcast_if_small, fits_broadcast, materialize

STAGES = [
    "loaded", "after_known_bad", "after_duplicates", "after_blank",
    "flagged_short", "flagged_long",
]


def drop_blocked(df: DataFrame, blocked=None, key: str = "link") -> DataFrame:
    """Remove blocklisted keys; a null key is never on the list and stays.

    A Python list becomes a predicate that reaches the Parquet scan. A table is
    anti-joined, broadcast when it measured small.
    """
    blocked = KNOWN_BAD_LINKS if blocked is None else blocked
    if isinstance(blocked, DataFrame):
        keys = blocked.select(key).filter(F.col(key).isNotNull()).distinct()
        return df.join(broadcast_if_small(keys, "blocked"), key, "left_anti")
    return df.filter(F.col(key).isNull() | ~F.col(key).isin(list(blocked)))


def _ranked(df, key, order, tie):
    """The first row of each key by order, then by a hash of the whole row."""
    ranked = Window.partitionBy(key).orderBy(*[F.asc_nulls_first(c) for c in order], tie)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, key: str = "link", order=("ord",), limit: int | None = None) -> DataFrame:
    """Keep one row of each key, the first by ``order``; null keys count as one key.

    Nulls come first. Rows of one key with equal order are told apart by a hash
    of their content, and of rows that are equal throughout one stays, so the
    answer is the same at every size.

    Only the narrow (key, order) columns are shuffled, pre-aggregated per task.
    The keys that do occur twice are then measured: when they fit a broadcast,
    the wide rows are filtered where they lie, and only rows that tie for the
    first place are shuffled. Otherwise a ranking window shuffles one row per
    key and task.
    """
    tie = F.xxhash64(*df.columns)
    first = F.struct(*order)
    repeated = materialize(
        df.groupBy(key)
        .agg(F.min(first).alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .select(F.col(key).alias("_key"), "_first"),
        "repeated-keys",
    )
    if not fits_broadcast(repeated, BROADCAST_BYTES if limit is None else limit):
        return _ranked(df, key, order, tie)
    same = F.col(key).eqNullSafe(F.col("_key"))
    narrow = df.select(key, first.alias("_at")).join(F.broadcast(repeated), same).filter("_at = _first")
    tied = materialize(narrow.groupBy("_key").count().filter("count > 1").select("_key"), "tied-keys")
    kept = df.join(F.broadcast(repeated), same, "left")
    kept = kept.filter(F.col("_first").isNull() | (F.col("_first") == first)).select(df.columns)
    if tied.isEmpty():
        return kept
    # tied keys are some of the repeated ones, which fit
    rest = kept.join(F.broadcast(tied), same, "left_anti")
    return rest.unionByName(_ranked(kept.join(F.broadcast(tied), same, "left_semi"), key, order, tie))


def drop_blank(df: DataFrame, text: str = "text_original") -> DataFrame:
    return df.filter(~is_blank(F.col(text)))


def flag_length(df, text="text_original", short=SHORT_CHARS, long=LONG_CHARS) -> DataFrame:
    """Advisory flags; no row is removed."""
    n = F.length(text)
    return df.withColumns(
        {"text_len": n, "is_short": n < short, "is_long": n > long}
    )


def clean(df: DataFrame, blocked=None, order=("ord",)) -> DataFrame:
    """The whole cleaning: the blank test comes after the dedupe on purpose, so
    a link whose first row is blank goes away altogether."""
    return flag_length(drop_blank(keep_first(drop_blocked(df, blocked), order=order)))


def flagged_short(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter("is_short")


def flagged_long(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter("is_long")


def _stages(counts: DataFrame, names) -> DataFrame:
    pairs = ", ".join(f"'{n}', {n}" for n in names)
    return counts.selectExpr(f"stack({len(names)}, {pairs}) as (stage, n_rows)")


def _before_dedupe(df: DataFrame, blocked) -> DataFrame:
    """Rows before and after the blocklist, from the link column alone, unshuffled."""
    links = df.select("link", F.lit(1).alias("_one"))
    if isinstance(blocked, DataFrame):
        keys = blocked.select("link").filter("link is not null").distinct().withColumn("_bad", F.lit(True))
        links = links.join(broadcast_if_small(keys, "blocked"), "link", "left")
        bad = F.coalesce(F.col("_bad"), F.lit(False))
    else:
        bad = F.coalesce(F.col("link").isin(list(KNOWN_BAD_LINKS if blocked is None else blocked)), F.lit(False))
    return _stages(links.agg(F.count("*").alias(STAGES[0]), F.count_if(~bad).alias(STAGES[1])), STAGES[:2])


def _after_dedupe():
    """Counts over flagged rows with a ``_blank`` mark, in the order of the stages."""
    shown = ~F.col("_blank")
    counts = [F.count("*"), F.count_if(shown), F.count_if(shown & F.col("is_short")), F.count_if(shown & F.col("is_long"))]
    return [c.alias(name) for c, name in zip(counts, STAGES[2:])]


def _marked(df, blocked, order) -> DataFrame:
    kept = keep_first(drop_blocked(df, blocked), order=order)
    return flag_length(kept).withColumn("_blank", is_blank(F.col("text_original")))


def clean_funnel(df: DataFrame, blocked=None, order=("ord",)) -> DataFrame:
    """(stage, n_rows): the rows left after each stage of ``clean``, by the same dedupe,
    so that both always agree. Rows are counted where they lie, without sorting."""
    counts = _marked(df, blocked, order).agg(*_after_dedupe())
    return _before_dedupe(df, blocked).unionByName(_stages(counts, STAGES[2:]))


def clean_observed(df: DataFrame, blocked=None, order=("ord",)):
    """(cleaned, funnel): the rows of ``clean``, and a function that gives the rows of
    ``clean_funnel`` once the cleaned ones were written.

    The job that writes the table counts its stages, so the texts are read once. It is
    the job's last stage that counts, whose tasks are counted once each, also after
    executors were lost.
    """
    seen = Observation()
    marked = _marked(df, blocked, order).observe(seen, *_after_dedupe())

    def funnel() -> DataFrame:
        late = [(name, seen.get[name]) for name in STAGES[2:]]
        return _before_dedupe(df, blocked).unionByName(df.sparkSession.createDataFrame(late, "stage string, n_rows bigint"))

    return marked.filter(~F.col("_blank")).drop("_blank"), funnel
