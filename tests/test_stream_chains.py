"""Roots by epoch, the edge index and parked walks."""

import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators import chains, edge_index as ei, key_buckets as kb
from tidepool.session import scratch_path
from tidepool.streaming import chains as sc

POST = "tweet_id string, parent_tweet_id string, kind string"


def forest(rng, n):
    """Posts in random order: regular ones, reshares of others, of unknown
    posts, of themselves in cycles, and of one hot post."""
    rows = []
    for i in range(n):
        if i % 5 == 0:
            rows.append((f"t{i}", None, "regular"))
        else:
            to = "t0" if rng.random() < 0.3 else "gone" if rng.random() < 0.05 else f"t{rng.randrange(n)}"
            rows.append((f"t{i}", to, "retweet"))
    rng.shuffle(rows)
    return rows


def plain_roots(rows):
    regular = {t for t, _, k in rows if k == "regular"}
    parent = {t: p for t, p, k in rows if k == "retweet"}
    out = {}
    for t in parent:
        at, met = parent[t], set()
        while at not in regular and at in parent and at not in met:
            met.add(at)
            at = parent[at]
        if at in regular:
            out[t] = at
    return out


def deliver(spark, deliveries, out=None, hot_rows=5, again=False):
    src, out, ck = scratch_path(spark, "t/src"), out or scratch_path(spark, "t/roots"), scratch_path(spark, "t/ck")
    for k, rows in enumerate(deliveries):
        spark.createDataFrame(rows, POST).coalesce(1).write.mode("append").parquet(src)
        for _ in range(2 if again else 1):
            sc.stream_roots(spark.readStream.schema(POST).parquet(src), out, ck, buckets=8, hot_rows=hot_rows).awaitTermination()
            if again:  # the epoch's commit is lost: it runs again
                again_path = spark._jvm.org.apache.hadoop.fs.Path(f"{ck}/commits/{k}")
                again_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(again_path, False)
    return out


@pytest.mark.parametrize("cuts,again", [([30, 60], False), ([10], True)])
def test_roots_by_epoch_equal_all_at_once(spark, cuts, again):
    rows = forest(random.Random(sum(cuts)), 90)
    edges = [0, *cuts, len(rows)]
    out = deliver(spark, [rows[a:b] for a, b in zip(edges, edges[1:])], again=again)
    want = plain_roots(rows)
    got = [tuple(r) for r in sc.current_roots(spark, out).collect()]
    assert len(got) == len(set(got)) and dict(got) == want
    n = {}
    for r in want.values():
        n[r] = n.get(r, 0) + 1
    assert {r[0]: r[1] for r in sc.current_root_counts(spark, out).collect()} == n


def test_late_parents_relabel_what_waits(spark):
    chain = [("a", None, "regular"), *[(f"c{i}", "a" if i == 0 else f"c{i - 1}", "retweet") for i in range(8)]]
    order = [[chain[8], chain[4]], [chain[6], chain[2], (None, "a", "retweet"), ("q", None, "reply"), ("n", None, "retweet")],
             [chain[7], chain[5], chain[3]], [chain[1]], [chain[0], ("c3", "x", "retweet")]]
    out = deliver(spark, order)
    assert {r[0]: r[1] for r in sc.current_roots(spark, out).collect()} == {f"c{i}": "a" for i in range(8)}


def test_an_epoch_reads_the_buckets_it_touches(spark):
    out = scratch_path(spark, "t/buckets")
    rows = spark.range(4000).selectExpr("concat('k', id) AS k", "id AS v")
    kb.put(rows, out, "k", "one", buckets=64)
    keys = spark.createDataFrame([("k5",), ("k6",), (None,)], "k string")
    read = kb.probe(spark, out, "k string, v long", "k", keys, buckets=64)
    assert {r["v"] for r in read.where("k in ('k5', 'k6')").collect()} == {5, 6}
    assert len(read.inputFiles()) and read.count() < 4000 * 4 / 64 + 100  # two buckets of 64
    assert kb.probe(spark, out, "k string, v long", "k", keys.limit(0), buckets=64).count() == 0
    assert kb.probe(spark, out + "-none", "k string, v long", "k", keys).count() == 0
    kb.put(rows.where("v < 10"), out, "k", "one", buckets=64)  # written again: replaced
    assert kb.everything(spark, out, "k string, v long").count() == 10


def posts(rng, n):
    kinds = ["regular", "retweet", "retweet", "reply"]
    rows = []
    for i in range(n):
        k = rng.choice(kinds)
        rows.append((f"t{i}", None if k == "regular" else "t0" if rng.random() < 0.2 else f"t{rng.randrange(n + 5)}", k))
    return rows


def saved(df):
    return {tuple(r) for r in df.select("tweet_id", "saved_to").collect()}


def test_walk_over_the_index_equals_the_closure(spark):
    rows = posts(random.Random(3), 120)
    archive = spark.createDataFrame(rows, POST)
    seeds = archive.where("hash(tweet_id) % 3 = 0").select("tweet_id")
    index, out = scratch_path(spark, "t/index"), scratch_path(spark, "t/out")
    ei.index_edges(archive.unionByName(archive.limit(20)), index, "all", buckets=16)
    ei.walk_delivery(spark, index, out, "seeds", None, seeds, buckets=16)
    assert saved(ei.saved_posts(spark, out)) == saved(chains.ingest_closure(seeds, archive))
    got, parked = ei.walk_indexed(seeds.limit(0).select(F.col("tweet_id").alias("fid"), F.lit("R").alias("phase")), index, 16)
    assert got.count() == 0 and parked.count() == 0


def test_a_hop_reads_what_its_frontier_touches(spark, monkeypatch):
    """A chain of single posts through a large archive reads a bucket a hop."""
    index, n = scratch_path(spark, "t/index"), 20_000
    archive = spark.range(n).selectExpr("concat('t', id) AS tweet_id", "if(id = 0, NULL, concat('t', id - 1)) AS parent_tweet_id",
                                        "if(id = 0, 'regular', 'retweet') AS kind")
    ei.index_edges(archive, index, "all", buckets=64)
    read, inner = [], ei.probe
    monkeypatch.setattr(ei, "probe", lambda *a, **k: (lambda df: read.append(df.count()) or df)(inner(*a, **k)))
    seed = spark.createDataFrame([("t6", "R")], "fid string, phase string")
    got, _ = ei.walk_indexed(seed, index, buckets=64)
    assert saved(got) == {("t0", "regular"), *((f"t{i}", "retweets") for i in range(1, 7))}
    assert len(read) == 7 and max(read) < 2 * n / 64


@pytest.mark.parametrize("full", [True, False])
def test_parents_delivered_last_give_the_same_tables(spark, full):
    rows = posts(random.Random(11), 100)
    archive = spark.createDataFrame(rows, POST)
    late = F.expr("pmod(hash(tweet_id), 4) > 1")
    stream = archive.where(~late) if full else archive.select("tweet_id")
    src, index, out, ck = (scratch_path(spark, f"t/{x}") for x in ("src", "index", "out", "ck"))
    stream.coalesce(1).write.parquet(src)
    sc.stream_walks(spark.readStream.schema(stream.schema).parquet(src), index, out, ck, buckets=16).awaitTermination()
    ei.refresh_archive(archive.where(late), index, out, "archive-1", buckets=16)
    if not full:
        ei.refresh_archive(archive.where(~late), index, out, "archive-2", buckets=16)
    ei.refresh_archive(archive.where(late), index, out, "archive-1", buckets=16)  # delivered again
    want = saved(chains.ingest_closure(stream.select("tweet_id"), archive))
    assert saved(ei.saved_posts(spark, out)) == want
