"""Reshare chains: parent kind, roots by pointer doubling, ingest closure,
and the per-root statistics built on them (J4, J5, J7, J11, A6-A9, A11).

Iterative operators cut lineage every round with a reliable
``checkpoint()`` into the session's shared checkpoint folder, so a lost
executor recomputes at most one round and plans do not grow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.text import split_entities, tokens
from tidepool.functions.urls import site_of
from tidepool.operators.skew import DEFAULT_HOT_ROWS, DEFAULT_MAX_HOT, lookup_join
from tidepool.operators.stats import top_n
from tidepool.session import checkpoint_dir, scratch_path

# kinds of a node id in the forest
_REGULAR, _PASS, _MISSING = 0, 1, 2
# the ingest closure folds its per-round parts into one table this often
COMPACT_EVERY = 16
# (id, phase) rows of a frontier that may be broadcast (some 50 MB)
FRONTIER_ROWS = 500_000


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (never a
    machine-local copy), returning a frame with a one-node lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def parent_kind(retweets: DataFrame, regular: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """``direct`` when a retweet's parent is a stored regular tweet,
    else ``undirect`` (broken chains included, as the reference counts)."""
    reg = regular.select(F.col("tweet_id").alias("_rid"))
    j = lookup_join(retweets.select("tweet_id", "parent_tweet_id"), "parent_tweet_id",
                    reg, "_rid", how="left", hot_rows=hot_rows)
    return j.select("tweet_id", F.when(F.col("_rid").isNotNull(), "direct")
                    .otherwise("undirect").alias("parent_kind"))


def resolve_roots(retweets: DataFrame, regular: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """``(tweet_id, root_id)`` for every retweet whose parent walk
    reaches a stored regular tweet; broken and cyclic chains are dropped.

    A walk steps through retweet ids that are not regular ids and stops at
    the first regular id. Pointer doubling: each row holds ``ptr`` and
    whether ``ptr`` is final; a row whose ptr is not final jumps to its
    ptr's own ptr, doubling the distance per round. The count of unfinished
    rows falls every round while an acyclic one remains; when it stops
    falling only cycles are left.
    """
    edges = retweets.select(F.col("tweet_id").alias("node"), F.col("parent_tweet_id").alias("ptr"))
    # One aggregation over every id: the kind a walk may stand on (regular
    # wins over pass-through) and how many reshares point at it; the latter
    # names the hot parents for the split join without a second pass.
    no_kind = F.lit(None).cast("int")
    ids = (regular.select(F.col("tweet_id").alias("id"), F.lit(_REGULAR).alias("k"), F.lit(0).alias("c"))
           .unionByName(edges.select(F.col("node").alias("id"), F.lit(_PASS).alias("k"), F.lit(0).alias("c")))
           .unionByName(edges.select(F.col("ptr").alias("id"), no_kind.alias("k"), F.lit(1).alias("c"))))
    kinds = ids.groupBy("id").agg(F.min("k").alias("kind"), F.sum("c").alias("children"))
    look = kinds.where(F.col("kind").isNotNull()).select(F.col("id").alias("_kid"), F.col("kind").alias("_kind"))
    hot = (kinds.where(F.col("children") >= hot_rows).orderBy(F.desc("children")).limit(DEFAULT_MAX_HOT)
           .select(F.col("id").alias("_hot")))
    first = lookup_join(edges, "ptr", look, "_kid", how="left", hot_rows=hot_rows, hot=hot).select(
        "node", "ptr", F.coalesce(F.col("_kind"), F.lit(_MISSING)).alias("ptr_kind"))
    # Inner nodes: retweets that are themselves reshared through (the
    # pass-through parent of some row). Every pointer still open is an
    # inner node, so only inner rows are ever looked up; in reshare forests
    # they are a small share (most reshares point straight at the original),
    # which keeps each round's lookup side small (AQE may then broadcast it
    # after checking its size) while the many leaf rows are only probed.
    inner = first.where(F.col("ptr_kind") == _PASS).select(F.col("ptr").alias("node")).distinct() \
        .withColumn("inner", F.lit(True))
    state = first.join(inner, "node", "left").select(
        "node", "ptr", "ptr_kind", F.coalesce("inner", F.lit(False)).alias("inner"))
    # written in two parts, so that the rounds scan the inner nodes alone
    path = scratch_path(state.sparkSession, "roots")
    state.write.partitionBy("inner").parquet(path)
    state = state.sparkSession.read.schema(state.schema).parquet(path)
    is_open, is_inner = F.col("ptr_kind") == _PASS, F.col("inner")
    n_open, n_leaves = state.agg(F.count_if(is_inner & is_open), F.count_if(~is_inner & is_open)).first()

    # A finished node is written once, in the round that finishes it.
    nodes = state.where(is_inner).select("node", "ptr", "ptr_kind")
    finished, open_rows, open_prev = [nodes.where(~is_open)], nodes.where(is_open), None
    while n_open and (open_prev is None or n_open < open_prev):
        # an open ptr is an inner node (nodes are unique); that node's
        # current ptr is the jump
        moved = cut_lineage(lookup_join(open_rows, "ptr", _hops(finished + [open_rows]), "_hn", how="inner",
                                        hot_rows=hot_rows, probe_rows=n_open)
                            .select("node", F.col("_hp").alias("ptr"), F.col("_hk").alias("ptr_kind")))
        finished.append(moved.where(~is_open))
        open_rows = moved.where(is_open)
        open_prev, n_open = n_open, open_rows.count()

    # the leaves whose parent is an inner node: one probe of where it ended
    leaves = lookup_join(state.where(~is_inner & is_open), "ptr", _hops(finished), "_hn", how="inner",
                         hot_rows=hot_rows, probe_rows=n_leaves)
    done = reduce(DataFrame.unionByName, [
        state.where(~is_inner & ~is_open).select("node", "ptr", "ptr_kind"), *finished,
        leaves.select("node", F.col("_hp").alias("ptr"), F.col("_hk").alias("ptr_kind"))])
    return done.where(F.col("ptr_kind") == _REGULAR).select(
        F.col("node").alias("tweet_id"), F.col("ptr").alias("root_id"))


def _hops(parts: list[DataFrame]) -> DataFrame:
    """Where each node's pointer now stands, as a lookup side."""
    return reduce(DataFrame.unionByName, parts).select(
        F.col("node").alias("_hn"), F.col("ptr").alias("_hp"), F.col("ptr_kind").alias("_hk"))


def retweets_per_root(roots: DataFrame) -> DataFrame:
    """Collected retweets per root (partial counts before the shuffle)."""
    return roots.groupBy("root_id").agg(F.count(F.lit(1)).alias("n_retweets"))


def top_roots(roots: DataFrame, n: int = 100) -> DataFrame:
    """G1: the n most reshared roots with their rank (1 = most); bounded
    to n rows, so it may be broadcast."""
    top = top_n(retweets_per_root(roots), "n_retweets", "root_id", n)
    # a window over at most n rows: one small task
    w = Window.orderBy(F.desc("n_retweets"), F.asc("root_id"))
    return top.withColumn("rank", F.row_number().over(w))


def chain_summary(retweets: DataFrame, regular: DataFrame, roots: DataFrame,
                  kinds: DataFrame) -> DataFrame:
    """Counts as ``(metric, value)`` rows, from two passes: one over
    the regular tweets, one over the retweets with their parent kind and
    root (a join on the unique ``tweet_id``). ``undirect`` includes chains
    that never reach a stored original; those are also ``broken`` (D8)."""
    per_rt = kinds.join(roots.select("tweet_id", "root_id"), "tweet_id", "left")
    rt = per_rt.agg(
        F.count(F.lit(1)).alias("retweets"),
        F.count_if(F.col("parent_kind") == "direct").alias("direct"),
        F.count_if(F.col("parent_kind") == "undirect").alias("undirect"),
        F.count("root_id").alias("resolved"),
        F.count_if(F.col("root_id").isNull()).alias("broken"),
        F.count_distinct("root_id").alias("roots_with_retweets"))
    names = ["retweets", "direct", "undirect", "resolved", "broken", "roots_with_retweets"]
    stacked = rt.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value"))
                                            for n in names])).alias("m")).select("m.*")
    reg = regular.agg(F.count(F.lit(1)).alias("value")).select(F.lit("regular").alias("metric"), "value")
    return stacked.unionByName(reg)


def collection_gap(roots: DataFrame, regular: DataFrame) -> DataFrame:
    """Collected vs reported reshare count per root."""
    per = retweets_per_root(roots)
    rep = regular.select(F.col("tweet_id").alias("root_id"), F.col("retweet_count").alias("reported"))
    return per.join(rep, "root_id", "inner").select(
        "root_id", F.col("n_retweets").alias("collected"), "reported",
        (F.col("reported") - F.col("n_retweets")).alias("gap"))


def root_details(ranked: DataFrame, regular: DataFrame) -> DataFrame:
    """Text and URLs of the ranked roots; the ranked side is bounded
    (top-n), so it is broadcast."""
    return regular.join(F.broadcast(ranked.withColumnRenamed("root_id", "tweet_id")), "tweet_id", "inner")


def topk_words(roots: DataFrame, regular: DataFrame, cuts=(10, 20, 50, 100), n: int = 20,
               stopwords=None) -> DataFrame:
    """Top n words over the texts of the top-k roots, for each cut k.

    Each root's words are counted once per cut it falls under (a root of
    rank r joins every cut >= r): ``explode`` of a fixed array, no join."""
    ranked = top_roots(roots, max(cuts))
    det = root_details(ranked, regular)
    cut_arr = F.array(*[F.lit(c) for c in sorted(cuts)])
    words = det.select("rank", F.explode(tokens("text", stopwords)).alias("word"))
    words = words.select(F.explode(F.filter(cut_arr, lambda c: c >= F.col("rank"))).alias("cut"), "word")
    counts = words.groupBy("cut", "word").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("cut").orderBy(F.desc("n"), F.asc("word"))
    return counts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def site_top(roots: DataFrame, regular: DataFrame, k: int = 100, n: int = 20) -> DataFrame:
    """A10 over chains: link sites of the top-k roots, top n."""
    det = root_details(top_roots(roots, k), regular)
    sites = det.select(F.explode(split_entities("expanded_urls", lower=False)).alias("url"))
    sites = sites.select(site_of("url").alias("site")).where(F.col("site").isNotNull())
    counts = sites.groupBy("site").agg(F.count(F.lit(1)).alias("n"))
    return top_n(counts, "n", "site", n)


def bot_share(roots: DataFrame, retweets: DataFrame, scores: DataFrame, k: int = 100,
              cut: float = 0.5) -> DataFrame:
    """Per top-k root, share of its collected retweets whose author
    scores above ``cut`` (missing score = not a bot; of several scores of an
    author the greatest counts). Retweets are first counted per (root, author), so a
    prolific account is one row per root before the score join."""
    ranked = top_roots(roots, k).select("root_id")
    mine = roots.join(F.broadcast(ranked), "root_id", "left_semi")
    authored = mine.join(retweets.select("tweet_id", "author_id"), "tweet_id", "inner")
    per_author = authored.groupBy("root_id", "author_id").agg(F.count(F.lit(1)).alias("c"))
    scored = per_author.join(scores.groupBy("author_id").agg(F.max("score").alias("score")), "author_id", "left")
    return scored.groupBy("root_id").agg(
        F.round(F.sum(F.when(F.col("score") > cut, F.col("c")).otherwise(0)) / F.sum("c"), 6)
        .alias("bot_share"))


def prepare_archive(archive: DataFrame) -> DataFrame:
    """The walk's view of an archive ``(tweet_id, parent_tweet_id, kind)``:
    its narrow edges, checkpointed once. Prepare once, reuse across rounds
    and micro-batches."""
    return cut_lineage(archive.select(F.col("tweet_id").alias("_aid"), F.col("parent_tweet_id").alias("_par"),
                                      F.col("kind").alias("_kind")))


def follow(hit: DataFrame) -> DataFrame:
    """One step of the ingest walk for frontier rows ``(fid, phase)`` joined
    with their edge ``(_par, _kind)``: what is saved and where it goes on."""
    ph, kd = F.col("phase"), F.col("_kind")
    return hit.select(
        F.col("fid").alias("tweet_id"),
        F.when((ph == "R") & (kd == "retweet"), "retweets")
         .when(kd == "regular", "regular").alias("saved_to"),
        F.when(kd == "reply", F.col("_par"))
         .when((ph == "R") & (kd == "retweet"), F.col("_par")).alias("next_id"),
        F.when(kd == "reply", "P").otherwise("R").alias("next_phase"))


def ingest_closure(seeds: DataFrame, archive: DataFrame) -> DataFrame:
    """What the stream ingester saves for a set of seed tweets.

    From each seed: while the tweet is a retweet, save it and fetch its
    parent; then, while it is a reply, fetch its parent; save the tweet
    reached if it is regular. A missing parent ends the walk, as does a
    retweet met while following replies (nothing more is saved).

    Breadth-first over a deduplicated frontier of ``(id, phase)``: every
    round joins the frontier with the archive (unique ids on both sides,
    so no hot key) and drops pairs seen before. A frontier counted at no more
    than ``FRONTIER_ROWS`` rows is broadcast, so that the archive stays where
    it is; a larger one is joined by a shuffle. Returns distinct
    ``(tweet_id, saved_to)`` with ``saved_to`` in {retweets, regular}.
    """
    arch = archive if "_aid" in archive.columns else prepare_archive(archive)
    frontier = cut_lineage(seeds.select(F.col("tweet_id").alias("fid"), F.lit("R").alias("phase")).distinct())
    seen_parts = [frontier]  # each round's frontier, checkpointed once
    saved_parts = []
    # every (id, phase) pair enters the frontier at most once, so the walk
    # ends after the longest chain, however long
    while n_front := frontier.count():
        near = F.broadcast(frontier) if n_front <= FRONTIER_ROWS else frontier
        hit = arch.join(near, F.col("fid") == F.col("_aid"), "inner")
        out = follow(hit)
        out = cut_lineage(out)
        got = out.where(F.col("saved_to").isNotNull()).select("tweet_id", "saved_to")
        saved_parts.append(got)
        nxt = (out.where(F.col("next_id").isNotNull())
               .select(F.col("next_id").alias("fid"), F.col("next_phase").alias("phase")).distinct())
        seen = reduce(DataFrame.unionByName, seen_parts)
        frontier = cut_lineage(nxt.join(seen, ["fid", "phase"], "left_anti"))
        seen_parts.append(frontier)
        if len(seen_parts) > COMPACT_EVERY:  # long chains: keep plans small
            seen_parts = [cut_lineage(reduce(DataFrame.unionByName, seen_parts))]
            saved_parts = [cut_lineage(reduce(DataFrame.unionByName, saved_parts))]
    if not saved_parts:
        return seeds.sparkSession.createDataFrame([], "tweet_id string, saved_to string")
    return reduce(DataFrame.unionByName, saved_parts).distinct()
