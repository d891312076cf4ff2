"""One seeded shuffle, nested prefixes of it, and a query sample."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.schemas import N_QUERIES, SCALES, SEED
from newsloom.session import broadcast_if_small

# Rows that one task numbers, about.
BUCKET_ROWS = 100_000
FEW_KEYS = 256
RADIX_DIGITS = 3  # hex digits of a hash that are counted at a time
HASH_DIGITS = 32


def salted_md5(column: str, salt) -> Column:
    return F.md5(F.concat(F.lit(f"{salt}:"), F.col(column).cast("string")))


def shuffle_positions(df: DataFrame, key: str = "vec_id", seed: int = SEED) -> DataFrame:
    """Add ``pos`` = 1..n in hash order of a unique key. Give it narrow rows.

    Rows are numbered in parallel inside hash buckets, whose number follows from
    the row count; the sizes of the buckets before it give each its offset. The
    position doesn't depend on the number of buckets.
    """
    digits = bucket_digits(df.count())
    hashed = df.withColumn("_h", salted_md5(key, seed)).withColumn("_bucket", F.substring("_h", 1, digits))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket
    offsets = broadcast_if_small(hashed.groupBy("_bucket").count().select(
        "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")
    ), store="bucket-offsets")
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_h", key))
    return (
        hashed.withColumn("_n", inside)
        .join(offsets, "_bucket")
        .withColumn("pos", F.col("_offset") + F.col("_n"))
        .drop("_h", "_bucket", "_n", "_offset")
    )


def bucket_digits(n: int) -> int:
    """Leading hex digits of the hash that name a bucket of about BUCKET_ROWS rows."""
    digits = 0
    while n > BUCKET_ROWS * 16**digits:
        digits += 1
    return max(digits, 1)


def first_by_hash(keys: DataFrame, key: str, salt, n: int) -> DataFrame:
    """The ``n`` keys that come first in hash order, for any n.

    Counts of the leading digits tell in which bucket the n-th key lies, and a bucket
    that is still large is counted by further digits. All keys of the buckets before it
    are taken by a filter where they lie; only the last bucket's are sorted. So few keys
    that one task can merge them from all tasks are sorted at once.
    """
    if n <= FEW_KEYS:
        return keys.select(key).orderBy(salted_md5(key, salt), key).limit(n)
    hashed = keys.select(key, salted_md5(key, salt).alias("_h"))
    prefix, left = "", n
    while True:
        inside = hashed.filter(F.startswith("_h", F.lit(prefix)))
        place = F.substring("_h", len(prefix) + 1, RADIX_DIGITS).alias("_b")
        counts = sorted((r["_b"], r["count"]) for r in inside.groupBy(place).count().collect())  # 16 ** RADIX_DIGITS at most
        for bucket, size in counts:
            if left <= size:
                break
            left -= size
        else:
            return keys.select(key)  # fewer keys than asked for
        prefix += bucket
        if size <= BUCKET_ROWS or len(prefix) >= HASH_DIGITS:
            break
    last = hashed.filter(F.startswith("_h", F.lit(prefix))).orderBy("_h", key).limit(left)
    return hashed.filter(F.col("_h") < prefix).select(key).union(last.select(key))


def first_rows(df: DataFrame, scale: int | None, key="vec_id", seed=SEED) -> DataFrame:
    """The rows that ``nested_sample`` gives, without numbering the others: the
    keys are taken in hash order and joined back."""
    if scale is None:
        return df
    keys = first_by_hash(df, key, seed, scale)
    return df.join(broadcast_if_small(keys, store="sample-keys"), key, "left_semi")


def nested_sample(positioned: DataFrame, scale: int | None) -> DataFrame:
    """The first ``scale`` rows of the shuffle; every scale holds the smaller ones."""
    return positioned if scale is None else positioned.filter(F.col("pos") <= scale)


def query_sample(df: DataFrame, scales=SCALES, n_queries=N_QUERIES, key="vec_id", seed=SEED) -> DataFrame:
    """Queries without replacement from the smallest scale, so that every scale
    is asked the same ones."""
    smallest = min((s for s in scales if s is not None), default=None)
    prefix = first_rows(df, smallest, key, seed)
    keys = first_by_hash(prefix, key, f"{seed}:query", n_queries)
    return prefix.join(broadcast_if_small(keys, store="query-keys"), key, "left_semi").withColumnRenamed(key, "qid")
