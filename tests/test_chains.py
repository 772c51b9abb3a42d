import random

import pytest

from tidepool.operators.chains import (bot_share, ingest_closure, parent_kind, resolve_roots,
                                       retweets_per_root)


def frames(spark, edges, regular, authors=None):
    rts = spark.createDataFrame(
        [(str(c), str(p), (authors or {}).get(c, "x")) for c, p in edges],
        "tweet_id string, parent_tweet_id string, author_id string")
    reg = spark.createDataFrame([(str(r),) for r in regular], "tweet_id string")
    return rts, reg


def walk(edges, regular):
    """The reference's walk, with a step bound standing in for its hang."""
    parent = dict(edges)
    out = {}
    for child, p in edges:
        seen = 0
        while p not in regular and p in parent and seen <= len(edges):
            p, seen = parent[p], seen + 1
        if p in regular:
            out[child] = p
    return out


def roots(spark, edges, regular, **kw):
    rts, reg = frames(spark, edges, regular)
    return {int(r.tweet_id): int(r.root_id) for r in resolve_roots(rts, reg, **kw).collect()}


def test_fixture_rows(spark):
    assert roots(spark, [(1, 0), (2, 1), (3, 9)], {0}) == {1: 0, 2: 0}
    assert roots(spark, [(1, 2), (2, 1)], set()) == {}
    assert roots(spark, [(2, 1), (1, 0)], {0, 1}) == {2: 1, 1: 0}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_forests_with_holes_cycles_and_hot_roots(spark, seed):
    rnd = random.Random(seed)
    n = 400
    regular = set(rnd.sample(range(n), 20))
    edges = []
    for c in range(n):
        if c in regular and rnd.random() < 0.7:
            continue
        r = rnd.random()
        p = 5 if r < 0.3 else (rnd.randrange(n + 50) if r < 0.9 else c + 1)  # hot 5, holes, cycles
        edges.append((c, p))
    regular.add(5)
    want = walk(edges, regular)
    assert roots(spark, edges, regular) == want
    assert roots(spark, edges, regular, hot_rows=3) == want  # hot-key split path


def test_parent_kind_and_counts(spark):
    rts, reg = frames(spark, [(1, 0), (2, 1), (3, 9)], {0})
    kinds = {r.tweet_id: r.parent_kind for r in parent_kind(rts, reg, hot_rows=1).collect()}
    assert kinds == {"1": "direct", "2": "undirect", "3": "undirect"}
    per = {r.root_id: r.n_retweets for r in retweets_per_root(resolve_roots(rts, reg)).collect()}
    assert per == {"0": 2}


def test_bot_share_counts_every_retweet(spark):
    edges = [(1, 0), (2, 0), (3, 0), (4, 0)]
    rts, reg = frames(spark, edges, {0}, authors={1: "a", 2: "a", 3: "b", 4: "c"})
    scores = spark.createDataFrame([("a", 0.9), ("b", 0.1)], "author_id string, score double")
    got = bot_share(resolve_roots(rts, reg), rts, scores).collect()
    assert [(r.root_id, r.bot_share) for r in got] == [("0", 0.5)]


def brute_closure(seeds, arch):
    """Per seed: save retweets while following them, then follow replies,
    save a regular tweet reached. A repeated id ends a walk (cycle)."""
    saved = set()
    for s in seeds:
        t, seen = s, set()
        while t in arch and arch[t][1] == "retweet" and t not in seen:
            seen.add(t)
            saved.add((t, "retweets"))
            t = arch[t][0]
        if t not in arch or t in seen:
            continue
        seen = set()
        while t in arch and arch[t][1] == "reply" and t not in seen:
            seen.add(t)
            t = arch[t][0]
        if t in arch and arch[t][1] == "regular":
            saved.add((t, "regular"))
    return saved


def test_ingest_closure_matches_walk(spark):
    rnd = random.Random(11)
    arch = {}
    for i in range(300):
        kind = rnd.choice(["regular", "reply", "retweet", "retweet"])
        arch[str(i)] = (str(rnd.randrange(i + 5)) if kind != "regular" else None, kind)
    seeds = [str(rnd.randrange(300)) for _ in range(60)]
    a = spark.createDataFrame([(k, p, kd) for k, (p, kd) in arch.items()],
                              "tweet_id string, parent_tweet_id string, kind string")
    s = spark.createDataFrame([(x,) for x in seeds], "tweet_id string")
    got = {(r.tweet_id, r.saved_to) for r in ingest_closure(s, a).collect()}
    assert got == brute_closure(seeds, arch)


def test_ingest_closure_long_chain_has_no_round_cap(spark):
    # 60 retweets in a row above one original: more rounds than one compaction period
    arch = [(str(i), str(i - 1) if i else None, "retweet" if i else "regular") for i in range(61)]
    a = spark.createDataFrame(arch, "tweet_id string, parent_tweet_id string, kind string")
    s = spark.createDataFrame([("60",)], "tweet_id string")
    got = {(r.tweet_id, r.saved_to) for r in ingest_closure(s, a).collect()}
    assert got == {(str(i), "retweets") for i in range(1, 61)} | {("0", "regular")}
