"""CSV read by byte ranges against Spark's own reader of whole files."""

import csv
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.plans import files as queries
from newsloom.sources import corpus, csv_ranges

LONG = 'long\nfield, with ""quotes"" and\r\n' * 60
ODD = (
    'a,b,c\n1,"x\ny, ""q""\n\nz",3\n"4",,""\n\n5,ab"c,"d"e\n6,"' + LONG + '",é\n7,"","\r\n"\r\n8,NA,9\n'
    + '"' + "\n" * 300 + '","two\nlines",""\n' + "9,plain,row\n" * 40 + '"open\nto, the end'
)


def landed(spark, folder, columns, size):
    df = csv_ranges.read_ranges(spark, str(folder), columns, size)
    with csv_ranges.fixed_ranges(spark, size):
        return df.collect()


@pytest.fixture
def files(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in (("f.csv", ODD), ("g.csv", 'a,b,c\n"1\n2",,'), ("h.csv", "a,b,c\n")):
        (folder / name).write_text(text, newline="")
    return folder


@pytest.mark.parametrize("size", [150, 700, 1 << 20])
def test_equals_the_reader_of_whole_files(spark, files, size):
    want = sorted(map(tuple, corpus.read_any_csv(spark, str(files)).collect()), key=str)
    rows = landed(spark, files, ["a", "b", "c"], size)
    assert sorted([(r["a"], r["b"], r["c"]) for r in rows], key=str) == want
    # the order of the file
    own = sorted((r for r in rows if r["source_file"].endswith("f.csv")), key=lambda r: r["ord"])
    assert len({r["ord"] for r in own}) == len(own)
    parsed = [row for row in csv.reader(io.StringIO(ODD, newline="")) if row][1:]
    assert [r["a"] for r in own] == [row[0] for row in parsed]


def test_one_file_is_the_work_of_many_tasks(spark, files, plan_of):
    with csv_ranges.fixed_ranges(spark, 150):
        lines = csv_ranges.lines_of(spark, str(files / "f.csv"))
        assert lines.rdd.getNumPartitions() > 10
        assert lines.select("start").distinct().count() > 5
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_a_range_that_moved_is_an_error(spark, files):
    df = csv_ranges.records_of(spark, str(files), 150)
    with csv_ranges.fixed_ranges(spark, 170), pytest.raises(Exception, match="split at other bytes"):
        df.collect()


def test_landing_keeps_names_order_and_missing_values(spark, tmp_path):
    (tmp_path / "x.csv").write_text('text_original,link,more\n"NA",l1,1\n"two\nlines",l2,2\n', newline="")
    rows = corpus.land(spark, str(tmp_path / "x.csv"), str(tmp_path / "out"), range_bytes=200).orderBy("ord").collect()
    assert [(r["link"], r["text_original"], r["category"]) for r in rows] == [("l1", None, None), ("l2", "two\nlines", None)]


FIELD = st.text(alphabet='a,"\n\r é', max_size=8)


@settings(deadline=None, max_examples=300)
@given(st.lists(st.lists(FIELD, min_size=2, max_size=2), min_size=1, max_size=6), st.integers(0, 40), st.integers(0, 40))
def test_states_chain_over_any_borders(rows, first, second):
    """Ranges cut at any two line ends give the records of the whole."""
    out = io.StringIO(newline="")
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(rows)
    lines = out.getvalue().split("\n")[:-1]
    cuts = sorted({0, min(first, len(lines)), min(second, len(lines)), len(lines)})
    inside, pieces, records = False, [], []
    for start, end in zip(cuts, cuts[1:]):
        readers = {False: csv_ranges._Reader(False), True: csv_ranges._Reader(True)}
        for line in lines[start:end]:
            found = {s: r.take(line) for s, r in readers.items()}
            if inside in found and found[inside] is not None:
                records.append(found[inside])
        said = readers[inside].answer()
        if said["head"] is not None:
            pieces.append(said["head"])
            if not readers[inside].continued:
                records.append("\n".join(pieces))
                pieces = []
        if said["tail"] is not None:
            pieces = [said["tail"]]
        inside = said["inside"]
    assert not inside and not pieces
    assert sorted(records) == sorted(",".join('"' + f.replace('"', '""') + '"' for f in row) for row in rows)


def test_no_task_writes_more_than_a_file(spark, tmp_path, monkeypatch):
    """A corpus that outgrows a file is written by several tasks, with the same rows."""
    rows = [(i, f"title {i}\n" + "text, " * 500, "src") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.repartition(8).write.parquet(str(tmp_path / "documents.parquet"))
    written = []
    write = corpus.write_csv
    monkeypatch.setattr(queries.files, "write_csv", lambda df, path, columns: written.append(path) or write(df, path, columns))

    def landed_rows():
        return sorted(map(str, queries.csv_ranges(spark, str(tmp_path)).collect()))

    one = landed_rows()
    monkeypatch.setattr(queries, "CSV_FILE_BYTES", 80_000)
    assert landed_rows() == one and len(one) == 80
    n_files = [spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).count() for path in written]
    assert n_files[0] == 1 and n_files[1] > 1
