import datetime as dt

from pyspark.sql import functions as F

from tidepool.operators.keyed import (append_new, assign_ids, new_by_key, retweet_ids, update_by_key,
                                      ensure_column, orphans)
from tidepool.operators.predicates import take_while_sorted
from tidepool.operators.windows import cap_pages_per_day, cap_per_day
from tidepool.sources.calendar import expected_days, missing_days


def test_append_new_first_wins_and_idempotent(spark):
    batch = spark.createDataFrame([("1", 1, "first"), ("1", 2, "second"), ("2", 3, "x")], "k string, seq int, v string")
    store = spark.createDataFrame([("2",)], "k string")
    new = append_new(batch, store, ["k"], ["seq"])
    assert [tuple(r) for r in new.collect()] == [("1", 1, "first")]
    stored = store.unionByName(new.select("k"))
    assert append_new(batch, stored, ["k"], ["seq"]).count() == 0


def test_new_by_key_with_ids(spark):
    store = spark.createDataFrame([(i, "b") for i in range(4)], "article_id long, url string")
    batch = spark.createDataFrame([("s", 1, "a"), ("s", 2, "a"), ("s", 3, "b"), ("s", 4, "c")],
                                  "source string, row int, url string")
    new = new_by_key(batch, store, ["url"], ["source", "row"])
    ided = assign_ids(new, store.count(), ["source", "row"])
    assert sorted((r.url, r.article_id) for r in ided.collect()) == [("a", 4), ("c", 5)]


def test_assign_ids_dense_over_partitions(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") * 7 % 5000).alias("o"))
    ided = assign_ids(df, 100, ["o"], num_partitions=7)
    got = sorted((r.o, r.article_id) for r in ided.collect())
    assert got == [(o, 100 + o) for o in range(5000)]


def test_update_by_key(spark):
    base = spark.createDataFrame([("k1", 1.0), ("k2", 2.0)], "key string, value double")
    upd = spark.createDataFrame([("k1", 9.0, 1), ("k1", 8.0, 0), ("k3", 5.0, 2)], "key string, value double, seq int")
    got = sorted(tuple(r) for r in update_by_key(base, upd, "key", ["value"], ["seq"]).collect())
    assert got == [("k1", 9.0), ("k2", 2.0)]
    assert "text" in ensure_column(base, "text", "string").columns


def test_retweet_ids_keeps_duplicates(spark):
    full = spark.createDataFrame([("1", "en"), ("1", "en"), ("2", "en"), ("3", "fr")], "tweet_id string, lang string")
    clean = spark.createDataFrame([("2", "en")], "tweet_id string, lang string")
    assert sorted(r[0] for r in retweet_ids(full, clean).collect()) == ["1", "1"]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,)], "fk int")
    parent = spark.createDataFrame([(1,)], "fk int")
    assert orphans(child, parent, "fk").count() == 2


def test_cap_pages_overshoots(spark):
    day = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, day + dt.timedelta(minutes=i)) for i in range(50)], "id int, ts timestamp")
    assert cap_pages_per_day(df, "ts", 20, 30, "id").count() == 40
    assert cap_per_day(df, "ts", 30, "id").count() == 30


def test_take_while_sorted(spark):
    df = spark.createDataFrame([("c", i, d) for i, d in enumerate([5, 4, 4, 6, 3])], "p string, o int, d int")
    for hot in (10, 1):
        got = take_while_sorted(df, "p", "o", "d", num_partitions=hot).orderBy("o").collect()
        assert [r.d for r in got] == [5, 4, 4]


def test_take_while_sorted_hot_part_spread(spark):
    import random
    rnd = random.Random(3)
    rows = []
    for p in range(30):
        n = 3000 if p == 7 else rnd.randint(1, 40)  # part 7 is hot
        d = 10_000
        for o in range(n):
            d -= rnd.choice([0, 1, 2]) if rnd.random() > 0.0005 else -5
            rows.append((p, o, d))
    df = spark.createDataFrame(rows, "p int, o int, d int")
    want = set()
    for p in range(30):
        seq = sorted((o, d) for pp, o, d in rows if pp == p)
        prev = None
        for o, d in seq:
            if prev is not None and d > prev:
                break
            want.add((p, o))
            prev = d
    for hot in (1, 13):
        got = {(r.p, r.o) for r in take_while_sorted(df, "p", "o", "d", num_partitions=hot).collect()}
        assert got == want


def test_calendar(spark):
    assert expected_days(spark, "2020-02").count() == 29
    have = spark.createDataFrame([(dt.date(2020, 2, 3),)], "day date")
    assert missing_days(have, "2020-02").count() == 28


def test_take_while_sorted_is_exact_for_large_ids_and_null_parts(spark):
    big = 2**60
    rows = [(p, o, d) for p in (big + 1, big + 2, None) for o, d in ((1, 9), (2, 8), (3, 8), (4, 9), (5, 1))]
    rows += [(7, 1, big), (7, 2, big + 1), (7, 3, big)]
    df = spark.createDataFrame(rows, "p long, o long, d long")
    for n in (1, 5):
        got = {(r.p, r.o) for r in take_while_sorted(df, "p", "o", "d", num_partitions=n).collect()}
        assert got == {(p, o) for p in (big + 1, big + 2, None) for o in (1, 2, 3)} | {(7, 1)}


def test_large_day_caps_rank_parts_first(spark):
    from pyspark.sql import functions as F
    from tidepool.operators.windows import cap_per_day
    df = spark.range(5000).select(F.col("id"), F.timestamp_seconds(F.col("id") % 7 + 1000).alias("ts"))
    got = cap_per_day(df, "ts", 1500, "id")
    want = df.orderBy("ts", "id").limit(1500)
    assert got.exceptAll(want).count() == 0 and got.count() == 1500
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Window ") == 2
