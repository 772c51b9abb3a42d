import json
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from tidepool.sources.tweets_json import stream_tweets
from tidepool.streaming.jobs import (append_keyed, classify_stream, current_table, daily_counts, parquet_stream,
                                     stream_dedup, stream_ingest, stream_update)


def post(i, kind="regular", parent=None):
    data = {"id": str(i), "author_id": "a", "created_at": f"2024-01-01T00:00:{i % 60:02d}.000Z", "text": "t",
            "public_metrics": {"like_count": 0, "quote_count": 0, "reply_count": 0, "retweet_count": 0}}
    env = {"data": data}
    if kind == "retweet":
        data["referenced_tweets"] = [{"type": "retweeted", "id": str(parent)}]
        env["includes"] = {"tweets": [{"id": str(parent), "author_id": "p"}]}
    return json.dumps(env)


def land(folder, name, lines):
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n\n")  # a trailing keep-alive blank line


def saved(spark, out):
    reg = spark.read.parquet(f"{out}/regular").select("tweet_id", F.lit("regular").alias("t"))
    rts = spark.read.parquet(f"{out}/retweets").select("tweet_id", F.lit("retweets").alias("t"))
    return sorted(tuple(r) for r in reg.unionByName(rts).collect())


def test_resume_processes_only_new_files_without_duplicates(spark):
    root = tempfile.mkdtemp(prefix="tidepool-stream-")
    src, out, ck = f"{root}/src", f"{root}/out", f"{root}/ck"
    os.makedirs(src)
    land(src, "a.json", [post(1), post(2, "retweet", 1), post(3)])
    stream_ingest(classify_stream(stream_tweets(spark, src)), out, ck).awaitTermination()
    first = saved(spark, out)
    assert first == [("1", "regular"), ("2", "retweets"), ("3", "regular")]
    # new file repeats tweet 3 and adds 4: a restarted job reads only b.json
    land(src, "b.json", [post(3), post(4, "retweet", 3), "{broken"])
    stream_ingest(classify_stream(stream_tweets(spark, src)), out, ck).awaitTermination()
    assert saved(spark, out) == first + [("4", "retweets")]


def test_keyed_append_is_idempotent_on_retry(spark):
    root = tempfile.mkdtemp(prefix="tidepool-retry-")
    batch = spark.createDataFrame([("b", 2), ("a", 1), ("a", 0)], "k string, seq int")
    append_keyed(batch, root, ["k"], ["seq"])
    append_keyed(batch, root, ["k"], ["seq"])  # the same epoch run again
    assert sorted(tuple(r) for r in spark.read.parquet(root).collect()) == [("a", 0), ("b", 2)]


def test_dedup_daily_and_update_streams(spark):
    root = tempfile.mkdtemp(prefix="tidepool-misc-")
    src = f"{root}/ev"
    ev = spark.createDataFrame(
        [(1, "u1", "2024-01-01 10:00:00", 5.0), (2, "u1", "2024-01-01 09:00:00", 7.0),
         (3, "u2", "2024-01-02 11:00:00", 1.0)], "event_id long, user_id string, ts string, value double") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    stream_dedup(stream, "user_id", ["ts", "event_id"], f"{root}/dd", f"{root}/ck1",
                 delay="1 day", ts_col="ts").awaitTermination()
    firsts = {r.user_id for r in spark.read.parquet(f"{root}/dd").collect()}
    assert firsts == {"u1", "u2"}
    daily_counts(stream, "ts", f"{root}/days", f"{root}/ck2").awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(f"{root}/days").collect()) == [
        ("2024-01-01", 2), ("2024-01-02", 1)]
    base = spark.createDataFrame([("u1", 0.0), ("u3", 3.0)], "key string, value double")
    base.write.parquet(f"{root}/bal/v=00000000")
    upd = stream.select(F.col("user_id").alias("key"), "value", "ts", "event_id")
    stream_update(upd, f"{root}/bal", "key", ["value"], ["ts", "event_id"], f"{root}/ck3").awaitTermination()
    got = sorted(tuple(r) for r in current_table(spark, f"{root}/bal", "key").collect())
    assert got == [("u1", 5.0), ("u3", 3.0)]


def uncommit(ck):
    """Forget the commit of the last epoch, as if the driver died before it."""
    last = max((f for f in os.listdir(f"{ck}/commits") if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(f"{ck}/commits/{f}"):
            os.remove(f"{ck}/commits/{f}")


def test_retried_and_late_updates(spark, tmp_path):
    base, src, ck = f"{tmp_path}/t", f"{tmp_path}/u", f"{tmp_path}/ck"
    spark.createDataFrame([(k, 0.0) for k in "abcdef"], "key string, value double").write.parquet(f"{base}/v=00000000")
    schema = "key string, value double, seq long"

    def deliver(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        run()

    def run():
        s = spark.readStream.schema(schema).parquet(src)
        stream_update(s, base, "key", ["value"], ["seq"], ck).awaitTermination()

    def now():
        return sorted(tuple(r) for r in current_table(spark, base, "key").collect())
    deliver([("a", 10.0, 10), ("b", 1.0, 1), ("zz", 9.0, 9)])
    deliver([("a", 5.0, 5), ("c", 2.0, 2)])  # an older update of a comes later
    want = [("a", 10.0), ("b", 1.0), ("c", 2.0), ("d", 0.0), ("e", 0.0), ("f", 0.0)]
    assert now() == want
    uncommit(ck)
    run()
    assert now() == want
    assert len(os.listdir(f"{base}/v=00000002")) < 8  # only touched buckets
    with pytest.raises(Exception, match="another checkpoint"):
        stream_update(spark.readStream.schema(schema).parquet(src), base, "key", ["value"], ["seq"], f"{ck}2").awaitTermination()


def test_retried_closed_days_and_dedup(spark, tmp_path):
    src = f"{tmp_path}/ev"
    ev = spark.createDataFrame([(i, f"u{i % 3}", f"2024-01-0{1 + i % 6} 10:00:00") for i in range(30)],
                               "id long, u string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    ev.write.parquet(src)

    def rows():
        return spark.readStream.schema(ev.schema).parquet(src)

    def days():
        return sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/days").select("day", "n").collect())
    daily_counts(rows(), "ts", f"{tmp_path}/days", f"{tmp_path}/c1", watermark="1 day").awaitTermination()
    first = days()
    assert len(first) == len(set(first)) == 4
    uncommit(f"{tmp_path}/c1")
    daily_counts(rows(), "ts", f"{tmp_path}/days", f"{tmp_path}/c1", watermark="1 day").awaitTermination()
    assert days() == first
    stream_dedup(rows(), "u", ["ts", "id"], f"{tmp_path}/dd", f"{tmp_path}/c2").awaitTermination()
    uncommit(f"{tmp_path}/c2")
    stream_dedup(rows(), "u", ["ts", "id"], f"{tmp_path}/dd", f"{tmp_path}/c2").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/dd").count() == 3


def test_read_faults_are_not_taken_for_an_empty_table(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        append_keyed(spark.createDataFrame([("a", 1)], "k string, seq int"), f"{tmp_path}/t", ["k"], ["seq"])


def test_unseen_tweets_and_their_parents_are_stored(spark, tmp_path):
    cols = "tweet_id string, parent_tweet_id string, kind string, created_at string"
    archive = spark.createDataFrame([("old", None, "regular", "0"), ("oldrt", "old", "retweet", "0"), ("answered", None, "regular", "0")], cols)
    src, out, ck = f"{tmp_path}/s", f"{tmp_path}/o", f"{tmp_path}/ck"

    def deliver(rows):
        spark.createDataFrame(rows, cols).coalesce(1).write.mode("append").parquet(src)
        stream_ingest(spark.readStream.schema(cols).parquet(src), out, ck, archive=archive).awaitTermination()
        return saved(spark, out)
    got = deliver([("new", None, "regular", "1"), ("newrt", "oldrt", "retweet", "1"), ("reply", "answered", "reply", "1"),
                   ("early", "later", "retweet", "1")])
    assert got == [("answered", "regular"), ("early", "retweets"), ("new", "regular"), ("newrt", "retweets"), ("old", "regular"),
                   ("oldrt", "retweets")]
    got = deliver([("later", None, "regular", "2"), ("rt2", "reply2", "retweet", "2"), ("reply2", "new2", "reply", "2"),
                   ("new2", None, "regular", "2")])
    assert [t for t in got if t[0] in ("later", "rt2", "new2")] == [("later", "regular"), ("new2", "regular"), ("rt2", "retweets")]


def _turns(spark, folder):
    """A conversations table kept as a folder of files."""
    rows = spark.range(4).selectExpr("id + 1 AS conv_id", "explode(sequence(0, 5)) AS turn").selectExpr("conv_id", "cast(turn AS int) AS turn")
    # conversation 1's turns 150 to 152 and conversation 2's turns 50 to 52 are the same posts with other edges
    more = spark.createDataFrame([(1, t) for t in range(148, 154)] + [(2, t) for t in range(48, 54)], "conv_id long, turn int")
    rows.unionByName(more).repartition(3, "conv_id", "turn").write.parquet(f"{folder}/conversations.parquet")


@pytest.mark.parametrize("name", ["stream_closure", "stream_walks"])
def test_walks_over_a_table_kept_as_a_folder(spark, name):
    import duckdb

    import __spark_entry__ as E
    root = tempfile.mkdtemp(prefix="tidepool-folder-")
    _turns(spark, root)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{root}/conversations.parquet/*.parquet')")
    want = con.execute(f"SELECT tweet_id, saved_to FROM ({E.oracle_sql()[name]})").fetchall()
    assert sorted(tuple(r) for r in E.queries()[name](spark, root).select("tweet_id", "saved_to").collect()) == sorted(want)


@pytest.mark.parametrize("glob, want", [("one.parquet", {1, 2}), ("split.parquet", {3, 4}), ("*.parquet", {1, 2, 3, 4}), ("days", {5, 6})])
def test_a_stream_reads_files_and_folders_alike(spark, glob, want):
    root, other = (tempfile.mkdtemp(prefix="tidepool-tables-") for _ in range(2))
    rows = lambda *n: spark.createDataFrame([(i,) for i in n], "n long")
    rows(1, 2).coalesce(1).write.parquet(f"{root}/one")
    os.rename(next(f.path for f in os.scandir(f"{root}/one") if f.name.endswith(".parquet")), f"{root}/one.parquet")
    rows(3, 4).repartition(2).write.parquet(f"{root}/split.parquet")
    rows(5, 6).withColumn("day", F.col("n") % 2).write.partitionBy("day").parquet(f"{other}/days")
    stream = parquet_stream(spark, other if glob == "days" else root, glob)
    assert ("day" in stream.columns) == (glob == "days")
    out = f"{other}/out"
    stream.writeStream.option("checkpointLocation", f"{other}/ck").trigger(availableNow=True).format("parquet").start(out).awaitTermination()
    assert {r["n"] for r in spark.read.parquet(out).collect()} == want
