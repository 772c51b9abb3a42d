"""Hydration that goes on where it stopped, and the rejects of a stream."""

import json

import pytest

from tidepool.operators import hydration as hy
from tidepool.session import scratch_path
from tidepool.sources.tweets_json import stream_tweets
from tidepool.streaming import jobs

SCHEMA = "tweet_id string, text string"


def tables(spark):
    ids = spark.range(200).selectExpr("concat('t', id % 150) AS tweet_id").unionByName(
        spark.createDataFrame([(None,), (None,), *[("t7",)] * 100], "tweet_id string"))  # repeats, NULLs and a hot id
    archive = spark.range(100, 400).selectExpr("concat('t', id) AS tweet_id", "concat('text ', id) AS text").unionByName(
        spark.createDataFrame([("t7", "seven"), (None, "none")], SCHEMA))
    return ids, archive


def rows(spark, out):
    got = [tuple(r) for r in hy.hydrated(spark, out, SCHEMA).collect()]
    assert len(got) == len(set(got))
    return set(got)


WANT = {(f"t{i}", f"text {i}") for i in range(100, 150)} | {("t7", "seven")}


@pytest.mark.parametrize("wave", [1, 4])
def test_stopped_runs_equal_one_run(spark, wave):
    ids, archive = tables(spark)
    out, done = scratch_path(spark, "t/hydrate"), []
    while n := hy.hydrate_slices(ids, archive, out, slices=9, wave=wave, stop_after=2):
        done.append(n)
        assert len(done) < 9 and rows(spark, out) <= WANT
    assert sum(done) == 9 and rows(spark, out) == WANT
    led = hy.ledger(spark, out).selectExpr("count(*)", "sum(n_ids)", "sum(n_found)").first()
    assert tuple(led) == (9, 150, len(WANT))


def test_a_wave_stopped_before_its_ledger_is_written_again(spark, monkeypatch):
    ids, archive = tables(spark)
    out, write = scratch_path(spark, "t/hydrate"), hy._replace

    def stops(df, path):
        if path.endswith("ledger"):
            raise RuntimeError("stopped")
        write(df, path)

    monkeypatch.setattr(hy, "_replace", stops)
    with pytest.raises(RuntimeError):
        hy.hydrate_slices(ids, archive, out, slices=6, wave=4)
    assert rows(spark, out) == set()
    monkeypatch.setattr(hy, "_replace", write)
    assert hy.hydrate_slices(ids, archive, out, slices=6, wave=3) == 6  # other waves than before
    assert rows(spark, out) == WANT and hy.hydrate_slices(ids, archive, out) == 0


def test_empty_tables_hydrate_to_nothing(spark):
    ids, archive = tables(spark)
    for i, a in ((ids.limit(0), archive), (ids, archive.limit(0))):
        out = scratch_path(spark, "t/hydrate")
        hy.hydrate_slices(i, a, out, slices=3)
        assert rows(spark, out) == set() and hy.open_slices(spark, out) == []


def envelope(i, **more):
    d = {"id": str(i), "author_id": "1", "created_at": "2020-01-01T00:00:00.000Z", "text": "x",
         "public_metrics": {"like_count": 1, "quote_count": 1, "reply_count": 1, "retweet_count": 1}}
    d.update(more)
    return json.dumps({"data": {k: v for k, v in d.items() if v is not None}})


def test_rejects_of_a_stream_are_kept_and_counted_once(spark):
    src, out, ck = (scratch_path(spark, f"t/{x}") for x in ("lines", "out", "ck"))
    first = [envelope(1), envelope(2, text=None), "{broken", envelope(3, author_id=None)]
    second = [envelope(1), envelope(4), "{broken", "{broken", envelope(5, created_at=None), "", envelope(6, public_metrics=None)]
    for k, lines in enumerate((first, second)):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(src)
        for _ in range(2):  # the epoch's commit is lost: it runs again
            q = jobs.stream_split(stream_tweets(spark, src), out, ck)
            q.awaitTermination()
            commit = spark._jvm.org.apache.hadoop.fs.Path(f"{ck}/commits/{k}")
            commit.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commit, False)
    assert {r[0]: r[1] for r in jobs.status_counts(spark, out).collect()} == {
        "valid": 3, "malformed": 3, "no text": 1, "no author": 1, "no time": 1, "no metrics": 1}
    assert sorted(r[0] for r in spark.read.parquet(f"{out}/regular").select("tweet_id").collect()) == ["1", "4"]
    from tidepool.operators.parse import parse_tweet_v2
    from tidepool.sources.tweets_json import read_tweets_v2
    parsed = parse_tweet_v2(read_tweets_v2(spark, src))
    kept = jobs.stream_rejects(spark, out, parsed.schema).groupBy("status").count().collect()
    assert {r[0]: r[1] for r in kept} == {"malformed": 3, "no text": 1, "no author": 1, "no time": 1, "no metrics": 1}


def test_a_stream_of_rejects_alone(spark):
    src, out, ck = (scratch_path(spark, f"t/{x}") for x in ("lines", "out", "ck"))
    assert jobs.status_counts(spark, out).collect() == []
    spark.createDataFrame([("{broken",)] * 300, "value string").write.text(src)
    jobs.stream_split(stream_tweets(spark, src), out, ck).awaitTermination()
    assert [tuple(r) for r in jobs.status_counts(spark, out).collect()] == [("malformed", 300)]
