"""NULL keys, repeated scores, equal sequences, ties of an ordered scan, and
days of an instant."""

import random

import pytest

from tidepool.operators import keyed
from tidepool.operators.articles import load_articles
from tidepool.operators.chains import bot_share
from tidepool.operators.predicates import take_while_sorted
from tidepool.operators.windows import cap_per_day
from tidepool.session import scratch_path
from tidepool.streaming import jobs


def test_rows_without_a_key_are_not_folded_or_appended_again(spark):
    batch = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("k", 2, "c"), ("k", 1, "d"), ("s", 1, "e")], "k string, o int, v string")
    stored = spark.createDataFrame([("s",), (None,)], "k string")
    got = keyed.append_new(batch, stored, ["k"], ["o"])
    assert [tuple(r) for r in got.collect()] == [("k", 1, "d")] and got.columns == batch.columns
    assert sorted(r["v"] for r in keyed.without_key(batch, ["k"]).collect()) == ["a", "b"]
    path = scratch_path(spark, "t/appended")
    for _ in range(2):
        jobs.append_keyed(batch, path, ["k"], ["o"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == ["d", "e"]


def test_a_hot_key_and_two_key_columns(spark):
    batch = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) AS a", "id % 2 AS b", "id AS o")
    got = keyed.append_new(batch, batch.where("a = 1"), ["a", "b"], ["o"])
    rows = {(r["a"], r["b"]): r["o"] for r in got.collect()}
    assert rows[(0, 0)] == 0 and rows[(0, 1)] == 3 and (1, 1) not in rows and len(rows) == 2001
    assert keyed.append_new(batch.limit(0), batch, ["a", "b"], ["o"]).count() == 0


def test_articles_without_an_address_are_rejected(spark):
    cols = "source string, row long, title string, content string, publishedAt string, url string"
    batch = spark.createDataFrame([("s", i, f"t{i}", "c", None, None if i < 3 else f"u{i}") for i in range(5)], cols)
    new, rejects = load_articles(batch, spark.createDataFrame([("u3",)], "url string"))
    assert [r["title"] for r in new.collect()] == ["t4"]
    assert sorted(r["title"] for r in rejects.collect()) == ["t0", "t1", "t2"]


def test_an_author_with_two_scores_counts_once(spark):
    roots = spark.createDataFrame([("r1", "a"), ("r2", "a"), ("r3", "a")], "tweet_id string, root_id string")
    rts = spark.createDataFrame([("r1", "x"), ("r2", "y"), ("r3", "z")], "tweet_id string, author_id string")
    scores = spark.createDataFrame([("x", 0.9), ("x", 0.1), ("x", 0.8), ("y", None), ("y", 0.2)], "author_id string, score double")
    assert bot_share(roots, rts, scores).first()["bot_share"] == pytest.approx(1 / 3, abs=1e-6)


def test_equal_sequences_take_the_greatest_values(spark):
    base = spark.createDataFrame([("k", 0), ("m", 0)], "key string, value int")
    ups = [("k", 1, 5), ("k", 1, 9), ("k", 1, 7), ("k", 0, 100), ("gone", 1, 1)]
    upd = spark.createDataFrame(ups, "key string, seq int, value int")
    want = {"k": 9, "m": 0}
    for df in (upd, upd.orderBy("value"), upd.orderBy(upd.value.desc())):
        assert {r[0]: r[1] for r in keyed.update_by_key(base, df, "key", ["value"], ["seq"]).collect()} == want
    for order in (ups, ups[::-1]):  # the same from a stream, in any order of deliveries
        path, src, ck = (scratch_path(spark, f"t/{x}") for x in ("table", "src", "ck"))
        base.write.parquet(f"{path}/v=00000000")
        for u in order:
            spark.createDataFrame([u], upd.schema).write.mode("append").parquet(src)
            jobs.stream_update(spark.readStream.schema(upd.schema).parquet(src), path, "key", ["value"], ["seq"], ck).awaitTermination()
        assert {r["key"]: r["value"] for r in jobs.current_table(spark, path, "key").collect()} == want


def plain_scan(rows):
    kept = []
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        kept += [r for r in mine if r[1] is None]
        scan = sorted((r for r in mine if r[1] is not None), key=lambda r: (r[1], r[2] is not None, r[2] or 0))
        for i, r in enumerate(scan):
            if i and r[2] is not None and scan[i - 1][2] is not None and r[2] > scan[i - 1][2]:
                break
            kept.append(r)
    return sorted(map(repr, kept))


@pytest.mark.parametrize("n", [1, 7])
def test_ordered_scan_with_ties_and_nulls(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, 1, 2, 3, 9, 9, 9]), rng.choice([None, *range(12)]), rng.choice([None, None, *range(-3, 1)]) if rng.random() < 0.5
             else 0) for _ in range(300)]
    rows = [(p, o, None if d is None else d - (o or 0)) for p, o, d in rows]  # mostly falling dates
    want = plain_scan(rows)
    for _ in range(2):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "part int, ord int, day int").repartition(5)
        got = take_while_sorted(df, "part", "ord", "day", num_partitions=n)
        assert got.columns == df.columns and sorted(map(repr, map(tuple, got.collect()))) == want
    assert take_while_sorted(df.limit(0), "part", "ord", "day").count() == 0


def test_days_of_instants_do_not_follow_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        df = spark.createDataFrame([(1, "2024-01-01T23:30:00Z"), (2, "2024-01-02T00:30:00Z"), (3, "2024-01-02T09:00:00Z")], "id int, t string") \
            .selectExpr("id", "to_timestamp(t) AS ts")
        for z in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert sorted(r["id"] for r in cap_per_day(df, "ts", 1, "id").collect()) == [1, 2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_load_report_scans_each_side_once(spark):
    from tidepool.operators.stats import load_report
    schema = "source string"
    before = spark.createDataFrame([("a",), (None,), ("<before>",)], schema)
    new = spark.createDataFrame([("hot",)] * 50 + [("b",), (None,), ("<after>",)], schema)
    got = sorted(((r["source"] or "", r["n"]) for r in load_report(before, new).collect()))
    assert got == [("", 1), ("<after>", 1), ("<after>", 56), ("<before>", 3), ("<inserted>", 53), ("b", 1), ("hot", 50)]
    empty = spark.createDataFrame([], schema)
    assert sorted(map(tuple, load_report(empty, empty).collect())) == [("<after>", 0), ("<before>", 0), ("<inserted>", 0)]
    plan = load_report(before, new)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 3  # either side once, and the names of the totals


def test_key_buckets_follow_the_size_of_the_base(spark, tmp_path, monkeypatch):
    from tidepool.streaming import jobs
    base, src, ck = (str(tmp_path / n) for n in ("base", "src", "ck"))
    spark.range(2000).selectExpr("id AS key", "0L AS value").write.parquet(f"{base}/v={0:08d}")
    assert jobs._buckets(spark, base) == jobs.LEAST_BUCKETS
    monkeypatch.setattr(jobs, "BUCKET_BYTES", 100)
    n = jobs._buckets(spark, base)
    assert n > jobs.LEAST_BUCKETS
    upd = spark.range(0, 2000, 2).selectExpr("id AS key", "id AS value", "1L AS seq")
    upd.write.parquet(src)
    for _ in range(2):  # the second run finds nothing to do
        jobs.stream_update(spark.readStream.schema(upd.schema).parquet(src), base, "key", ["value"], ["seq"], ck).awaitTermination()
    assert jobs._buckets(spark, base) == n
    got = {r["key"]: r["value"] for r in jobs.current_table(spark, base, "key").collect()}
    assert got == {k: k if k % 2 == 0 else 0 for k in range(2000)}
