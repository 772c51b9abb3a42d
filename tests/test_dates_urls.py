from pyspark.sql import functions as F

from tidepool.functions.dates import date_reject, normalize_date
from tidepool.functions.urls import absolute_url, site_of

ROWS = [
    ("Medicine-Today", "2020-01-30", "2020-01-30"),
    ("GreatGameIndia", "2020-03-25T20:07:28+00:00", "2020-03-25"),
    ("TheMindUnleashed", "2020-03-16T22:26:31-05:00", "2020-03-16"),
    ("Intellihub", "2020-03-15T09:42:55Z", "2020-03-15"),
    ("HealthImpactNews", "March 18, 2020", "2020-03-18"),
    ("HealthNutNews", "Jan 28, 2020", "2020-01-28"),
    ("WND", "March 25, 2020 at 1:40pm", "2020-03-25"),
    ("WorldHealth", "Feb 19, 2020,  2 p.m.", "2020-02-19"),
    ("ZeroHedge", "Tue, 02/25/2020 - 17:48", "2020-02-25"),
    ("RealFarmacy", "", None),
    ("X", "junk", None),
]


def test_normalize_dates(spark):
    df = spark.createDataFrame(ROWS, "source string, raw string, want string")
    out = df.select("want", F.date_format(normalize_date("raw", F.col("source")), "yyyy-MM-dd").alias("got"),
                    date_reject("raw", F.col("source")).alias("rej")).collect()
    for r, row in zip(out, ROWS):
        assert r.got == r.want, row
    assert [r.rej for r in out] == [False] * 10 + [True]


def test_site_of(spark):
    df = spark.createDataFrame([("HTTP://u@H.com:80/p?q",), ("no scheme",), ("https://a.b",)], "u string")
    got = [r[0] for r in df.select(site_of("u")).collect()]
    assert got == ["http://u@H.com:80/", None, "https://a.b/"]


def test_absolute_url(spark):
    df = spark.createDataFrame([("/x", "https://a.b/c/d"), ("//cdn/x", "https://a.b/"),
                                ("https://z/", "https://a.b/")], "l string, p string")
    got = [r[0] for r in df.select(absolute_url("l", "p")).collect()]
    assert got == ["https://a.b/x", "//cdn/x", "https://z/"]


def test_tweet_time_both_shapes(spark):
    from tidepool.functions.dates import tweet_time
    from tidepool.operators.predicates import time_range_utc
    df = spark.createDataFrame([("Wed Oct 10 20:19:24 +0000 2018",), ("2018-10-10T20:19:24.000Z",),
                                ("Wed Oct 10 21:19:24 +0100 2018",), ("junk",)], "c string")
    secs = [r[0] for r in df.select(F.unix_timestamp(tweet_time("c"))).collect()]
    assert secs == [1539202764, 1539202764, 1539202764, None]
    t = df.withColumn("t", tweet_time("c"))
    assert time_range_utc(t, "t", "2018-10-10 20:19:24", "2018-10-10 20:19:25").count() == 3
    assert time_range_utc(t, "t", "2018-10-10 20:19:25", "2018-10-11 00:00:00").count() == 0


def test_utc_helpers_ignore_session_zone(spark):
    import datetime as dt
    from tidepool.functions.dates import ntz_as_utc, utc_day
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 30),)], "t timestamp_ntz")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = set()
        for tz in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = df.select(F.unix_seconds(ntz_as_utc("t")).alias("s"), utc_day(ntz_as_utc("t")).alias("d")).first()
            got.add((r.s, r.d))
        assert got == {(1704151800, "2024-01-01")}
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
