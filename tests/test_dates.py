from pyspark.sql import functions as F

from newsloom.functions.dates import corpus_date, feed_date, shard_stamp

FEED = {
    "Fri, 24 Feb 2022 23:30:00 +0200": "24.02.2022",
    "Fri, 25 Feb 2022 01:30:00 +0300": "24.02.2022",
    "5 Mar 2022 00:10:00 GMT": "05.03.2022",
    "Sat, 01 Jun 2024 23:30:00 EST": "02.06.2024",
    "2024-06-01T00:10:00+03:00": "31.05.2024",
    "2024-06-01T00:10:00Z": "01.06.2024",
    "1 Jun 2024 00:10:00 XYZ": "",
    "bad": "",
    None: "",
}


def test_feed_date(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(FEED)], "i int, s string")
    assert [r[0] for r in df.orderBy("i").select(feed_date(F.col("s"))).collect()] == list(FEED.values())


def test_feed_date_is_utc_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.createDataFrame([("Fri, 24 Feb 2022 23:30:00 +0000",)], "s string")
        assert df.select(feed_date(F.col("s"))).first()[0] == "24.02.2022"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_corpus_date_never_guesses(spark):
    df = spark.createDataFrame([("05.03.2022",), ("24.02.2022",), ("bad",), (None,)], "s string")
    days = [r[0] for r in df.select(F.date_format(corpus_date(F.col("s")), "yyyy-MM-dd")).collect()]
    assert days == ["2022-03-05", "2022-02-24", None, None]


def test_shard_stamp(spark):
    df = spark.sql("select timestamp'2024-06-01 07:08:09' as t")
    assert df.select(shard_stamp(F.col("t"))).first()[0] == "2024-06-01T070809Z"
