import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from newsloom.operators import clean
from newsloom.schemas import CORPUS_COLUMNS, SHARD_COLUMNS
from newsloom.sources import corpus, feeds, manifest, shards

HEADER = "link,date,title_original,text_original,title_ukrainian,text_ukrainian,category\n"


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        HEADER
        + 'a,24.02.2022,"He said ""hi""","line one\nline two, with comma",,,news\n'
        + 'b,NA,"",None,x,y,n/a\n'
        + "a,25.02.2022,t,later copy,,,news\n",
        encoding="utf-8",
    )
    return str(path)


def test_csv_quotes_newlines_and_missing_texts(spark, csv_file):
    rows = corpus.read_csv(spark, csv_file).collect()
    assert rows[0]["title_original"] == 'He said "hi"'
    assert rows[0]["text_original"] == "line one\nline two, with comma"
    assert rows[0]["title_ukrainian"] is None
    assert [rows[1][c] for c in CORPUS_COLUMNS] == ["b", None, None, None, "x", "y", None]


def test_missing_input_is_an_error(spark, tmp_path):
    for read in (corpus.read_csv, manifest.read_manifest):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            read(spark, str(tmp_path / "absent")).count()


def test_landing_keeps_file_order(spark, csv_file, tmp_path):
    landed = corpus.land(spark, csv_file, str(tmp_path / "landed"))
    kept = clean.keep_first(landed, order=("source_file", "ord"))
    assert {r["link"]: r["date"] for r in kept.collect()}["a"] == "24.02.2022"
    funnel = clean.clean_funnel(landed, order=("source_file", "ord")).collect()
    assert {r["stage"]: r["n_rows"] for r in funnel}["after_blank"] == 1


def test_csv_round_trip(spark, csv_file, tmp_path):
    df = corpus.read_csv(spark, csv_file)
    corpus.write_csv(df, str(tmp_path / "out"))
    assert sorted(map(str, corpus.read_csv(spark, str(tmp_path / "out")).collect())) == sorted(map(str, df.collect()))


def test_any_csv_keeps_header_names(spark, tmp_path):
    (tmp_path / "x.csv").write_text("link,odd\n1,2\n")
    assert corpus.read_any_csv(spark, str(tmp_path / "x.csv")).columns == ["link", "odd"]


def test_size_guard_and_text_dump(spark, csv_file, tmp_path):
    assert corpus.undersized_files(spark, csv_file).count() == 1
    assert corpus.undersized_files(spark, csv_file, floor=10).count() == 0
    assert corpus.file_sizes(spark, csv_file).first()["size_mb"] > 0
    corpus.dump_text(corpus.read_csv(spark, csv_file).limit(1), str(tmp_path / "dump"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "dump")).collect()] == ["line one", "line two, with comma"]


def test_write_cleaned(spark, tmp_path):
    df = spark.createDataFrame(
        [(0, *["l0", "d", "t", "x", None, None, "c"]), (1, *["l1", "d", "t", "x" * 20_001, None, None, "c"])],
        "ord bigint, " + ", ".join(f"{c} string" for c in CORPUS_COLUMNS),
    )
    corpus.write_cleaned(clean.clean(df), str(tmp_path / "out"))
    sizes = [spark.read.parquet(str(tmp_path / "out" / n)).count() for n in ("cleaned", "flagged_short", "flagged_long")]
    assert sizes == [2, 1, 1]


def test_manifest(spark, tmp_path):
    (tmp_path / "seen.txt").write_text("a\n\n  b \na\n")
    seen = manifest.read_manifest(spark, str(tmp_path / "seen.txt"))
    assert sorted(r["link"] for r in seen.collect()) == ["a", "b"]
    merged = manifest.merge_links(seen, spark.createDataFrame([("c",), ("a",)], "link string"))
    assert [r["link"] for r in merged.collect()] == ["a", "b", "c"]
    target = str(tmp_path / "manifest")
    manifest.write_manifest(merged, target)
    manifest.write_manifest(spark.createDataFrame([("d",)], "link string"), target, "append")
    assert sorted(r["link"] for r in manifest.read_manifest(spark, target).collect()) == ["a", "b", "c", "d"]


def test_manifest_reads_only_links(spark, plan_of, tmp_path):
    spark.createDataFrame([("a", "long text")], "link string, text_original string").write.parquet(str(tmp_path / "c"))
    plan = plan_of(manifest.build_manifest(spark.read.parquet(str(tmp_path / "c"))))
    assert "ReadSchema: struct<link:string>" in plan


def shard_rows(spark, *links):
    return spark.createDataFrame([(k, "d", "t", "", "x", "", "c") for k in links], ", ".join(f"{c} string" for c in SHARD_COLUMNS))


def test_shards_are_written_once_each(spark, tmp_path):
    path = str(tmp_path / "shards")
    assert shards.write_shard(shard_rows(spark, "a", "b"), path, "2024-01-01T000000Z")
    assert shards.write_shard(shard_rows(spark, "c"), path, "2024-01-02T000000Z")
    assert shards.write_shard(shard_rows(spark, "a", "b"), path, "2024-01-01T000000Z")
    assert not shards.write_shard(shard_rows(spark, "a").limit(0), path, "2024-01-03T000000Z")
    got = shards.read_shards(spark, path)
    assert got.count() == 3 and shards.list_shards(got).count() == 2
    assert {r["shard"] for r in shards.list_shards(got).collect()} == {"2024-01-01T000000Z", "2024-01-02T000000Z"}


def test_csv_shards_take_their_name_from_the_file(spark, tmp_path):
    (tmp_path / "2024-01-01T000000Z.csv").write_text(",".join(SHARD_COLUMNS) + "\nl,d,t,,x,,c\n")
    row = shards.read_csv_shards(spark, str(tmp_path)).first()
    assert (row["shard"], row["text_original"]) == ("2024-01-01T000000Z", "x")


def test_combined_matches_columns_by_name(spark):
    base = spark.createDataFrame([("l", "d", "t", "text", "tu", "xu", "c")], ", ".join(f"{c} string" for c in CORPUS_COLUMNS))
    both = shards.combined(base, shard_rows(spark, "s").withColumn("shard", F.lit("run")))
    assert {(r["link"], r["text_original"], r["shard"]) for r in both.collect()} == {("l", "text", "base"), ("s", "x", "run")}


def test_feed_entries(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(
        '<?xml version="1.0"?><rss xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>'
        "<item><title> T &amp; U </title><link>l1</link><category>one</category><category>two</category>"
        "<pubDate>Fri, 24 Feb 2022 23:30:00 +0200</pubDate>"
        "<content:encoded><![CDATA[<p>body</p>]]></content:encoded></item>"
        "<item><title>bare</title><link>l2</link></item></channel></rss>"
    )
    items = feeds.read_feed(spark, str(tmp_path / "feed.xml"))
    rows = {r["link"]: r for r in feeds.feed_entries(items).collect()}
    assert rows["l1"]["category"] == "one" and rows["l1"]["title"] == "T & U" and rows["l1"]["content"] == "<p>body</p>"
    assert rows["l2"]["category"] == "" and rows["l2"]["content"] == "" and rows["l2"]["published"] is None
    assert feeds.broken_items(items).first()["broken_items"] == 0


def test_broken_items_are_counted_not_fatal(spark, tmp_path):
    (tmp_path / "feed.xml").write_text("<rss><item><title>ok</title><link>l</link></item><item><title>x</link></item></rss>")
    items = feeds.read_feed(spark, str(tmp_path / "feed.xml")).cache()
    assert feeds.broken_items(items).first()["broken_items"] >= 1
    assert [r["link"] for r in feeds.feed_entries(items).collect()] == ["l"]


def test_stored_positions_are_neither_sorted_nor_shuffled(spark, tmp_path, plan_of):
    from newsloom.operators import embed

    rows = [(i // 50, "same") for i in range(200)]  # equal rows have places of their own
    spark.createDataFrame(rows, "k int, v string").coalesce(1).sortWithinPartitions("k").repartitionByRange(4, "k").write.parquet(str(tmp_path / "t"))
    placed = embed.with_stored_position(spark, str(tmp_path / "t"))
    found = placed.orderBy("position").collect()
    assert [r["position"] for r in found] == list(range(200))
    assert [r["k"] for r in found] == sorted(r["k"] for r in found)
    plan = plan_of(placed, "simple")
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "Sort" not in plan
    (tmp_path / "u").mkdir()
    spark.createDataFrame(rows[:-1], "k int, v string").write.parquet(str(tmp_path / "u" / "x"))
    with pytest.raises(ValueError, match="row count mismatch"):
        embed.join_stored(spark, str(tmp_path / "t"), str(tmp_path / "u" / "x"))
