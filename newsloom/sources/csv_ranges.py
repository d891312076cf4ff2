"""Quoted CSV read in parallel, also where a single file holds it all.

A line end may lie inside quotes, so a byte range of a file doesn't know whether it
starts inside a field. Three steps resolve that:

1. every range runs through its lines for both states it may start in, and tells in
   which state each ends, how many records start in it, and what it holds of records
   that reach over its borders;
2. per file, these answers are chained from the start of the file, which fixes the
   state in which each range starts. The chain sees one small row per range; the
   pieces at the borders are then put together by the range in which their record
   began;
3. every range is read once more, from its known state, and gives the records that
   lie in it as a whole.

Lines come from Spark's text source, which splits files by bytes and tells the range
of each line; records are taken apart by Spark's CSV parser. Quotes are doubled
inside quoted fields; a quote inside an unquoted field, or after the closing one, is
an ordinary character, as in that parser. A file that ends inside quotes ends its
last record; one record is never split over rows, however long. Blank lines between
records are skipped, and a carriage return before a line end outside quotes belongs to
it. A compressed file is one range.
"""

import contextlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import BROADCAST_BYTES, materialize

RANGE_BYTES = 128 * 1024 * 1024
RECORDS = 4096  # that a task hands on at a time
START_BYTES = 200  # of a range's place and state in a task, besides its file's name
QUOTED = re.compile(r'[^"]*+(?:""[^"]*+)*+')  # what a quoted field holds after its first quote

_ANSWER = "struct<inside:boolean,fresh:boolean,n:bigint,head:string,tail:string>"
ANSWERS = f"file string, start bigint, out {_ANSWER}, in {_ANSWER}"
STARTS = "file string, start bigint, inside boolean, began bigint"
WHOLE = "file string, start bigint, n bigint, record string"


@contextlib.contextmanager
def fixed_ranges(spark, range_bytes=RANGE_BYTES):
    """Split files at the same bytes in every job of the block, whatever the number of
    cores at the time."""
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(range_bytes), "spark.sql.files.minPartitionNum": "1",
        "spark.sql.files.maxPartitionNum": None,
    }
    before = {key: spark.conf.get(key, None) for key in wanted}

    def put(settings):
        for key, value in settings.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)

    put(wanted)
    try:
        yield
    finally:
        put(before)


def lines_of(spark, path) -> DataFrame:
    """(file, start, line): the lines of all files with the first byte of their range."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that starts inside a quoted field, or not, ends inside one."""
    at = 0
    if not inside:
        if not line.startswith('"'):
            at = line.find(',"') + 1
            if not at:
                return False
        at += 1
    while True:
        at = QUOTED.match(line, at).end()
        if at == len(line):
            return True
        # behind the closing quote: on to the next field that starts with one
        at = line.find(',"', at) + 2
        if at == 1:
            return False


class _Reader:
    """Joins the lines of a range to records, from a given state."""

    def __init__(self, inside):
        self.inside = self.continued = inside
        self.record, self.n, self.head = [], 0, None

    @property
    def between(self):
        return not self.inside and not self.continued

    def take(self, line):
        """The record that ends with this line, if it also started in the range."""
        if not self.inside and not line.strip("\r"):
            return None
        self.record.append(line)
        if '"' in line:
            self.inside = ends_inside(line, self.inside)
        if self.inside:
            return None
        text, self.record = "\n".join(self.record), []
        if self.continued:
            self.head, self.continued = text, False
            return None
        self.n += 1
        return text

    def answer(self, ahead=None):
        """What the range says from this state. ``ahead`` is the reader that this one
        agrees with since both were between records, and by how many records it leads."""
        last, lead = ahead or (self, 0)
        rest = "\n".join(last.record) if last.inside else None
        head, tail = (rest, None) if last.continued else (self.head, rest)
        return {"inside": last.inside, "fresh": tail is not None, "n": last.n - lead, "head": head, "tail": tail}


def _ranges(batches):
    """(file, start, lines), range by range; the lines of a range may come in several
    pieces, which follow each other."""
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        lines, at = batch.column(2).to_pylist(), 0
        while at < len(keys):
            end = at
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            yield keys[at], lines[at:end]
            at = end


def _answers(batches):
    """A row for each range, as soon as the next one begins."""
    kind = pa.struct([("inside", pa.bool_()), ("fresh", pa.bool_()), ("n", pa.int64()), ("head", pa.string()), ("tail", pa.string())])

    def row(key, out, in_, ahead):
        values = [[key[0]], [key[1]], [out.answer()], [in_.answer(ahead)]]
        kinds = [pa.string(), pa.int64(), kind, kind]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["file", "start", "out", "in"])

    last = None
    for key, lines in _ranges(batches):
        if key != last:
            if last is not None:
                yield row(last, out, in_, ahead)
            last, out, in_, ahead = key, _Reader(False), _Reader(True), None
        for line in lines:
            out.take(line)
            if ahead is None:
                in_.take(line)
                if out.between and in_.between:
                    ahead = out, out.n - in_.n
    if last is not None:
        yield row(last, out, in_, ahead)


def _chained(ranges: pd.DataFrame) -> pd.DataFrame:
    """The state in which each range of one file starts, and the range in which the
    record began that is open there."""
    inside, began, rows = False, -1, []
    for r in ranges.sort_values("start").itertuples():
        rows.append((r.file, r.start, inside, began if inside else -1))
        if r.fresh_in if inside else r.fresh_out:
            began = r.start
        inside = r.inside_in if inside else r.inside_out
    return pd.DataFrame(rows, columns=["file", "start", "inside", "began"])


def _whole(inside):
    """The records that lie in one range. ``n`` counts the records that start in it, so
    that start + n rises along the file: no record is shorter than a byte."""

    def batch_of(rows):
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "start", "n", "record"])

    def run(batches):
        last, rows = None, []
        for key, lines in _ranges(batches):
            if key != last:
                if key not in inside:
                    raise ValueError(f"{key[0]} was split at other bytes than before")
                last, reader = key, _Reader(inside[key])
            for line in lines:
                record = reader.take(line)
                if record is not None:
                    rows.append((*key, reader.n - 1, record))
            while len(rows) >= RECORDS:
                yield batch_of(rows[:RECORDS])
                rows = rows[RECORDS:]
        yield batch_of(rows)

    return run


def records_of(spark, path, range_bytes=RANGE_BYTES) -> DataFrame:
    """(source_file, ord, record): the records of all files, each as it is written.
    ``ord`` rises along a file. To be used within a ``fixed_ranges`` block of the same
    range size; a range that turns out another than at first is an error."""
    lines = lines_of(spark, path)
    with fixed_ranges(spark, range_bytes):
        answers = materialize(lines.mapInArrow(_answers, ANSWERS), "csv-ranges")
    narrow = answers.select("file", "start", *[
        F.col(f"{state}.{name}").alias(f"{name}_{state}") for state in ("out", "in") for name in ("inside", "fresh")])
    starts = materialize(narrow.groupBy("file").applyInPandas(_chained, STARTS), "csv-starts")
    if (starts.agg(F.sum(F.octet_length("file") + START_BYTES)).first()[0] or 0) > BROADCAST_BYTES:
        raise ValueError("too many ranges to name in a task: set a larger range_bytes")
    inside = {(r["file"], r["start"]): r["inside"] for r in starts.collect()}
    whole = lines.mapInArrow(_whole(inside), WHOLE)
    return whole.unionByName(materialize(_over_borders(answers, starts), "csv-borders")).select(
        F.col("file").alias("source_file"), (F.col("start") + F.col("n")).alias("ord"),
        F.regexp_replace("record", r"\r\z", "").alias("record"))


def _over_borders(answers, starts) -> DataFrame:
    """The records that reach over borders, put together from their pieces."""
    said = answers.join(starts, ["file", "start"]).select(
        "file", "start", "began", F.when(F.col("inside"), F.col("in")).otherwise(F.col("out")).alias("it"))
    first = said.filter("it.tail is not null").select("file", F.col("start").alias("began"), "start", "it.n", F.col("it.tail").alias("piece"))
    later = said.filter("began >= 0 and it.head is not null").select(
        "file", "began", "start", F.lit(None).cast("bigint").alias("n"), F.col("it.head").alias("piece"))
    # the piece with a number comes first: a range may end one record and begin the next
    order = F.struct(F.col("n").isNull().alias("later"), "start", "piece")
    pieces = first.unionByName(later).groupBy("file", "began").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(order)).alias("parts"))
    return pieces.select(
        "file", F.col("began").alias("start"), "n", F.array_join(F.transform("parts", lambda p: p["piece"]), "\n").alias("record"))


def read_ranges(spark, path, columns, range_bytes=RANGE_BYTES) -> DataFrame:
    """All records of quoted CSV files as strings under the given names, with
    (source_file, ord). The first record of each file is its header and is left out.
    To be used as ``records_of`` is."""
    records = records_of(spark, path, range_bytes).filter("ord > 0")  # the header is number 0 of the range at 0
    schema = ", ".join(f"`{c}` string" for c in columns)
    parsed = F.from_csv("record", schema, {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"})
    return records.select(parsed.alias("_row"), "source_file", "ord").select("_row.*", "source_file", "ord")
