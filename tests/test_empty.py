"""Operators on empty inputs return empty results (no driver-side errors)."""

from tidepool.operators.chains import bot_share, ingest_closure, resolve_roots, topk_words
from tidepool.operators.keyed import append_new, assign_ids, update_by_key
from tidepool.operators.predicates import take_while_sorted


def test_empty_inputs(spark):
    rts = spark.createDataFrame([], "tweet_id string, parent_tweet_id string, author_id string")
    reg = spark.createDataFrame([], "tweet_id string, text string, expanded_urls string, retweet_count long")
    roots = resolve_roots(rts, reg)
    assert roots.count() == 0
    assert topk_words(roots, reg).count() == 0
    scores = spark.createDataFrame([], "author_id string, score double")
    assert bot_share(roots, rts, scores).count() == 0
    arch = spark.createDataFrame([], "tweet_id string, parent_tweet_id string, kind string")
    assert ingest_closure(rts.select("tweet_id"), arch).count() == 0
    kv = spark.createDataFrame([], "k string, seq int")
    assert append_new(kv, kv.select("k"), ["k"], ["seq"]).count() == 0
    assert assign_ids(kv, 5, ["seq"]).count() == 0
    base = spark.createDataFrame([], "k string, v double")
    assert update_by_key(base, spark.createDataFrame([], "k string, v double, s int"), "k", ["v"], ["s"]).count() == 0
    od = spark.createDataFrame([], "p int, o int, d int")
    assert take_while_sorted(od, "p", "o", "d").count() == 0
    assert take_while_sorted(od, "p", "o", "d", num_partitions=3).count() == 0
