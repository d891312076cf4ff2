"""Whitespace, sentence-like chunks, repetition statistics, boilerplate cut."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.schemas import BOILERPLATE_MARKERS, MIN_CHUNK_CHARS, REPEAT_THRESHOLD, WHITESPACE


def strip(c) -> Column:
    """Python's ``str.strip``: drops every Unicode whitespace character."""
    return F.trim(c, F.lit(WHITESPACE))


def rstrip(c) -> Column:
    return F.rtrim(c, F.lit(WHITESPACE))


def is_blank(c) -> Column:
    return strip(F.coalesce(c, F.lit(""))) == ""


def chunks(text) -> Column:
    """Stripped pieces between full stops that have more than 20 characters."""
    pieces = F.transform(F.split(F.coalesce(text, F.lit("")), r"\."), strip)
    return F.filter(pieces, lambda p: F.length(p) > MIN_CHUNK_CHARS)


def chunk_stats(text, repeat_threshold: int = REPEAT_THRESHOLD) -> Column:
    """Struct(total_chunks, unique_chunks, dup_ratio, max_repeat, highly_repeated_chunks).

    A text lies in one row, so its chunks are sorted inside the row and equal
    neighbours are counted; nothing is exploded or shuffled. ``dup_ratio`` is
    the share of unique chunks (1.0 when there is no chunk).
    """
    zero = F.struct(
        F.lit(None).cast("string").alias("prev"),
        F.lit(0).alias("run"),
        F.lit(0).alias("total"),
        F.lit(0).alias("uniq"),
        F.lit(0).alias("longest"),
        F.lit(0).alias("high"),
    )

    def step(acc, chunk):
        run = F.when(acc["prev"].eqNullSafe(chunk), acc["run"] + 1).otherwise(1)
        return F.struct(
            chunk.alias("prev"),
            run.alias("run"),
            (acc["total"] + 1).alias("total"),
            (acc["uniq"] + F.when(run == 1, 1).otherwise(0)).alias("uniq"),
            F.greatest(acc["longest"], run).alias("longest"),
            # a run passes the threshold exactly once
            (acc["high"] + F.when(run == repeat_threshold, 1).otherwise(0)).alias("high"),
        )

    def finish(acc):
        ratio = F.try_divide(acc["uniq"].cast("double"), acc["total"].cast("double"))
        return F.struct(
            acc["total"].alias("total_chunks"),
            acc["uniq"].alias("unique_chunks"),
            F.coalesce(ratio, F.lit(1.0)).alias("dup_ratio"),
            acc["longest"].alias("max_repeat"),
            acc["high"].alias("highly_repeated_chunks"),
        )

    return F.aggregate(F.sort_array(chunks(text)), zero, step, finish)


def most_repeated(text, top: int = 5) -> Column:
    """Array of struct(repeats, first_pos, chunk): the ``top`` most repeated
    chunks of one text, equal counts in order of first appearance."""
    seen = F.transform(chunks(text), lambda c, i: F.struct(c.alias("chunk"), i.alias("pos")))
    # neg_n sorts high counts first under the natural struct order
    zero = F.struct(
        F.lit(None).cast("string").alias("chunk"),
        F.lit(0).alias("n"),
        F.lit(0).alias("pos"),
        F.expr("cast(array() as array<struct<neg_n:int,pos:int,chunk:string>>)").alias("best"),
    )

    def close(acc):
        entry = F.struct(
            (-acc["n"]).alias("neg_n"), acc["pos"].alias("pos"), acc["chunk"].alias("chunk")
        )
        return F.slice(F.sort_array(F.array_append(acc["best"], entry)), 1, top)

    def step(acc, x):
        same = acc["chunk"].eqNullSafe(x["chunk"])
        return F.struct(
            x["chunk"].alias("chunk"),
            F.when(same, acc["n"] + 1).otherwise(1).alias("n"),
            F.when(same, acc["pos"]).otherwise(x["pos"]).alias("pos"),
            F.when(same | acc["chunk"].isNull(), acc["best"]).otherwise(close(acc)).alias("best"),
        )

    def finish(acc):
        best = F.when(acc["chunk"].isNull(), acc["best"]).otherwise(close(acc))
        return F.transform(
            best,
            lambda b: F.struct(
                (-b["neg_n"]).alias("repeats"), b["pos"].alias("first_pos"), b["chunk"].alias("chunk")
            ),
        )

    return F.aggregate(F.sort_array(seen), zero, step, finish)


def boilerplate_cut(text, markers=None) -> Column:
    """Cut from the earliest marker on (any case), then strip the right end.

    Text without a marker comes back unchanged, trailing space included.
    """
    markers = BOILERPLATE_MARKERS if markers is None else markers
    if not markers:
        return text
    low = F.lower(text)
    found = [F.nullif(F.locate(m.lower(), low), F.lit(0)) for m in markers]
    cut = F.least(*found) if len(found) > 1 else found[0]
    return F.when(cut.isNull(), text).otherwise(rstrip(F.substring(text, F.lit(1), cut - 1)))


def preview(c, n: int = 100) -> Column:
    return F.substring(c, 1, n)
