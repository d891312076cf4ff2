"""Cleaning, profile and audit on rows that sit on the edges."""

import pytest
from pyspark.sql import functions as F

from newsloom.operators import audit, clean, profile
from newsloom.schemas import CORPUS_COLUMNS, KNOWN_BAD_LINKS

ROWS = [
    (0, "a", "24.02.2022", "  "), (1, "a", "05.03.2022", "text"),
    (2, None, "bad", "x" * 99), (3, None, None, "y"),
    (4, "nbsp", "24.02.2022", " \n"), (5, KNOWN_BAD_LINKS[0], "24.02.2022", "bad"),
    (6, "l99", "24.02.2022", "x" * 99), (7, "l100", "24.02.2022", "x" * 100),
    (8, "l20000", "24.02.2022", "x" * 20_000), (9, "l20001", "25.02.2022", "x" * 20_001),
    (10, "l100", "24.02.2022", "later"), (11, "null", "24.02.2022", None),
]


@pytest.fixture
def edges(spark):
    return spark.createDataFrame(ROWS, "ord bigint, link string, date string, text_original string")


def flags(df):
    return {r["ord"]: (r["is_short"], r["is_long"]) for r in df.collect()}


WANT = {2: (True, False), 6: (True, False), 7: (False, False), 8: (False, False), 9: (False, True)}


def test_clean_edges(edges):
    assert flags(clean.clean(edges)) == WANT


def test_blocklist_table_equals_list(spark, edges):
    table = spark.createDataFrame([(k,) for k in KNOWN_BAD_LINKS + [None]], "link string")
    assert flags(clean.clean(edges, table)) == WANT


def test_null_links_survive_the_blocklist(edges):
    assert clean.drop_blocked(edges, ["a"]).filter("link is null").count() == 2


def test_keep_first_without_broadcast_gives_the_same(edges):
    want = sorted(r["ord"] for r in clean.keep_first(edges).collect())
    assert sorted(r["ord"] for r in clean.keep_first(edges, limit=-1).collect()) == want == [0, 2, 4, 5, 6, 7, 8, 9, 11]


def test_keep_first_with_two_order_columns(spark):
    df = spark.createDataFrame([("k", "b", 0), ("k", "a", 5), ("k", "a", 7)], "link string, f string, n int")
    for limit in (None, -1):
        rows = clean.keep_first(df, order=("f", "n"), limit=limit).collect()
        assert [(r["f"], r["n"]) for r in rows] == [("a", 5)]


TIED = [("a", 1, "x"), ("a", 1, "y"), ("b", None, "n"), ("b", None, "m"), ("c", None, "q"), ("c", 2, "r"), (None, None, "z"),
        (None, None, "z"), ("d", 1, "s"), ("d", 1, "s"), ("e", 5, "t"), ("f", 3, None), ("f", 3, "u")]


def test_keep_first_has_one_answer_for_ties_and_nulls(spark):
    df = spark.createDataFrame(TIED, "link string, ord int, text string").repartition(7)
    both = [sorted(map(str, clean.keep_first(df, limit=limit).collect())) for limit in (None, -1)]
    assert both[0] == both[1] and len(both[0]) == 7
    two = df.withColumn("f", F.when(F.col("ord") > 1, F.lit("late")))
    both = [sorted(map(str, clean.keep_first(two, order=("f", "ord"), limit=limit).collect())) for limit in (None, -1)]
    assert both[0] == both[1] and len(both[0]) == 7


def test_keep_first_of_a_hot_key(spark):
    df = spark.range(30_000).select(F.col("id").alias("ord"), F.expr("if(id % 3 = 0, 'hot', cast(id as string))").alias("link"))
    for limit in (None, -1):
        kept = clean.keep_first(df, limit=limit)
        assert kept.count() == 20_001
        assert kept.filter("link = 'hot'").first()["ord"] == 0


def test_keep_first_ranks_before_it_shuffles(edges, plan_of):
    assert "WindowGroupLimit" in plan_of(clean.keep_first(edges, limit=-1))


def test_keep_first_moves_no_wide_row(edges, plan_of):
    plan = plan_of(clean.keep_first(edges))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_funnel(spark, edges):
    want = {
        "loaded": 12, "after_known_bad": 11, "after_duplicates": 8, "after_blank": 5,
        "flagged_short": 2, "flagged_long": 1,
    }
    table = spark.createDataFrame([(k,) for k in KNOWN_BAD_LINKS], "link string")
    for blocked in (None, table):
        got = {r["stage"]: r["n_rows"] for r in clean.clean_funnel(edges, blocked).collect()}
        assert got == want


def test_profile(edges):
    row = profile.corpus_profile(edges).first()
    assert row["n_rows"] == 12
    assert row["duplicate_links"] == 3  # a, null and l100 once each
    assert row["missing_texts"] == 1
    assert (row["first_date"], row["last_date"]) == ("2022-02-24", "2022-03-05")
    assert row["unparseable_dates"] == 2


def test_profile_without_optional_columns(edges):
    row = profile.corpus_profile(edges.select("ord")).first()
    assert row["n_rows"] == 12
    assert row["duplicate_links"] is None and row["missing_texts"] is None and row["unparseable_dates"] is None


def test_schema_check(edges):
    assert ("extra", "ord") in profile.schema_diff(edges)
    assert ("missing", "category") in profile.schema_diff(edges)
    rows = {r["column_name"]: (r["kind"], r["filled_rows"]) for r in profile.schema_check(edges).collect()}
    assert rows["link"] == ("expected", 10) and rows["ord"] == ("extra", 12) and rows["category"] == ("missing", 0)
    assert set(CORPUS_COLUMNS) <= set(rows)


def test_link_lookup(edges):
    assert audit.link_lookup(edges, "^l").first()["ord"] == 6
    assert audit.link_lookup(edges, "7160484").count() == 0


def test_longest_and_sweep(spark, edges):
    assert [r["ord"] for r in audit.longest(edges.filter("link is not null"), 2).collect()] == [9, 8]
    counts = spark.createDataFrame([(0,), (1,), (3,), (30,)], "highly_repeated_chunks int")
    got = [(r["threshold"], r["rows_above"]) for r in audit.threshold_sweep(counts).collect()]
    assert got == [(0, 3), (1, 2), (2, 2), (5, 1), (10, 1), (20, 1)]
    assert {r["rows_above"] for r in audit.threshold_sweep(counts.limit(0)).collect()} == {0}


def test_audit_stays_in_the_jvm_and_moves_nothing(edges, plan_of):
    plan = plan_of(audit.repeat_audit(edges))
    assert "Exchange" not in plan and "EvalPython" not in plan and "MapIn" not in plan


def test_list_rows(spark):
    df = spark.createDataFrame([("a", "d", "t", "x", 1)], "link string, date string, title_original string, text_original string, n int")
    assert audit.list_rows(df).columns == ["link", "date", "title_original", "text_original"]


def counted(cleaned):
    rows = cleaned.collect()
    return len(rows), sum(r["is_short"] for r in rows), sum(r["is_long"] for r in rows)


@pytest.mark.parametrize("order", [("ord",), ("ord", "day")])
def test_funnel_agrees_with_the_table_on_ties_and_nulls(spark, order, tmp_path):
    rows = [
        ("a", None, 1, ""), ("a", 1, 1, "x" * 120), ("b", 1, 1, ""), ("b", 1, 1, "y" * 120), ("c", None, None, "z"),
        ("c", None, None, " "), ("d", 2, 1, "short"), ("d", 2, 1, "short"), (None, 1, 1, "n" * 30_000), (None, 1, None, ""),
        (KNOWN_BAD_LINKS[0], 1, 1, "bad"), ("e", 5, 2, None), ("e", 5, 1, "w" * 200),
    ]
    df = spark.createDataFrame(rows, "link string, ord int, day int, text_original string")
    kept, short, long = counted(clean.clean(df, order=order))
    got = {r["stage"]: r["n_rows"] for r in clean.clean_funnel(df, order=order).collect()}
    assert got == {"loaded": 13, "after_known_bad": 12, "after_duplicates": 6, "after_blank": kept, "flagged_short": short, "flagged_long": long}
    cleaned, funnel = clean.clean_observed(df, order=order)
    cleaned.write.parquet(str(tmp_path / "cleaned"))
    assert {r["stage"]: r["n_rows"] for r in funnel().collect()} == got
    assert counted(spark.read.parquet(str(tmp_path / "cleaned"))) == (kept, short, long)


def test_funnel_does_not_sort(edges, plan_of):
    assert "SortAggregate" not in plan_of(clean.clean_funnel(edges, order=("date", "ord")), "simple")
