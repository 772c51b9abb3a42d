"""Streams over reshare chains: walks that are parked at unknown parents (T1,
J11), and reshare roots kept up by epoch (J5, A6, A11).

Both keep their state in key buckets (``operators.key_buckets``): an epoch
reads the buckets its ids touch and writes a delivery of its own, so that a
retried epoch replaces what it wrote and reads none of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.chains import cut_lineage, resolve_roots
from tidepool.operators.edge_index import index_edges, walk_delivery
from tidepool.operators.key_buckets import BUCKETS, everything, probe, put
from tidepool.operators.skew import DEFAULT_HOT_ROWS, lookup_join

NODES = "tweet_id string, top string, done boolean, reshare boolean, epoch long"
WAITING = "tweet_id string, top string"
COUNTS = "root_id string, n_retweets long"


def _name(epoch: int) -> str:
    return f"epoch-{epoch:08d}"


def stream_walks(rows: DataFrame, index: str, out: str, checkpoint: str, buckets: int = BUCKETS, trigger: dict | None = None):
    """T1 with the ingest walk over an edge index (``edge_index``). Each
    epoch's posts are walked from; posts that come with ``parent_tweet_id`` and
    ``kind`` are added to the index first, and walks that an earlier epoch
    parked at one of them go on. ``edge_index.refresh_archive`` does the same
    for posts that an archive brings. Results: ``edge_index.saved_posts``."""
    def sink(batch: DataFrame, epoch: int):
        batch = batch.persist()
        edge = ["tweet_id", "parent_tweet_id", "kind"]
        added = index_edges(batch.select(*edge), index, _name(epoch), buckets) if set(edge) <= set(batch.columns) else None
        walk_delivery(batch.sparkSession, index, out, _name(epoch), added, batch, buckets)
        batch.unpersist()

    w = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def stream_roots(rows: DataFrame, out: str, checkpoint: str, buckets: int = BUCKETS, hot_rows: int = DEFAULT_HOT_ROWS,
                 trigger: dict | None = None):
    """J5 by epoch: the root of every reshare of a stream of posts
    ``(tweet_id, parent_tweet_id, kind)`` (kinds ``regular`` and ``retweet``;
    others and NULL ids are left out), without going over the history again.

    A node table holds, for each post, the top its walk has reached: a regular
    post (done) or a post that has not arrived. A new reshare looks up only its
    parent's top; chains inside the epoch are resolved by pointer doubling over
    the epoch's rows (``resolve_roots``). Open reshares are also kept by the
    post they wait for: when it arrives, all that wait for it get its top. The
    first arrival of an id counts (in one epoch a regular post before a
    reshare, then the smallest parent); cycles never have a root."""
    def sink(batch: DataFrame, epoch: int):
        _root_epoch(batch, out, epoch, buckets, hot_rows)

    w = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def _root_epoch(batch: DataFrame, out: str, epoch: int, buckets: int, hot_rows: int) -> None:
    spark, name = batch.sparkSession, _name(epoch)
    posts = batch.where("tweet_id IS NOT NULL AND kind IN ('regular', 'retweet')")
    posts = cut_lineage(posts.groupBy("tweet_id").agg((F.min("kind") == "retweet").alias("reshare"), F.min("parent_tweet_id").alias("parent")))
    ids = posts.select("tweet_id").unionByName(posts.where("reshare").select(F.col("parent").alias("tweet_id")))
    held = probe(spark, f"{out}/nodes", NODES, "tweet_id", ids, buckets, without=name)
    held = held.join(ids.where("tweet_id IS NOT NULL").distinct(), "tweet_id", "left_semi")
    held = cut_lineage(held.groupBy("tweet_id").agg(F.max_by(F.struct("top", "done"), "epoch").alias("l"))
                       .select(F.col("tweet_id").alias("_id"), "l.top", "l.done"))
    fresh = cut_lineage(posts.join(held.select("_id"), F.col("tweet_id") == F.col("_id"), "left_anti"))

    # where a walk goes on from each new reshare: to its parent if that is new
    # too, else to the parent's top, else it waits for the parent
    new_id = fresh.select(F.col("tweet_id").alias("_new"))
    steps = lookup_join(fresh.where("reshare AND parent IS NOT NULL").select("tweet_id", "parent"), "parent", new_id, "_new", how="left", hot_rows=hot_rows)
    steps = lookup_join(steps, "parent", held, "_id", how="left", hot_rows=hot_rows)
    known = F.col("_new").isNull() & F.col("_id").isNotNull()
    steps = cut_lineage(steps.where(~known | F.col("top").isNotNull()).select(
        "tweet_id", F.when(known, F.col("top")).otherwise(F.col("parent")).alias("parent_tweet_id"),
        (known & F.col("done")).alias("to_root")))
    # walks end at new regular posts and at what is not new
    ends = (steps.join(new_id, F.col("parent_tweet_id") == F.col("_new"), "left_anti")
            .groupBy(F.col("parent_tweet_id").alias("tweet_id")).agg(F.max("to_root").alias("root")))
    ends = cut_lineage(ends.unionByName(fresh.where("NOT reshare").select("tweet_id", F.lit(True).alias("root"))))
    tops = resolve_roots(steps.select("tweet_id", "parent_tweet_id"), ends.select("tweet_id"), hot_rows)
    tops = lookup_join(tops.withColumnRenamed("tweet_id", "_t"), "root_id", ends.withColumnRenamed("tweet_id", "_e"), "_e", hot_rows=hot_rows)
    labels = cut_lineage(
        fresh.where("reshare").join(tops.select("_t", "root_id", "root"), F.col("tweet_id") == F.col("_t"), "left")
        .select("tweet_id", F.col("root_id").alias("top"), F.coalesce("root", F.lit(False)).alias("done"), F.lit(True).alias("reshare"))
        .unionByName(fresh.where("NOT reshare").select("tweet_id", F.col("tweet_id").alias("top"), F.lit(True).alias("done"), F.lit(False).alias("reshare"))))

    woken = probe(spark, f"{out}/waiting", WAITING, "top", new_id, buckets, without=name).withColumnRenamed("top", "_for")
    label = labels.select(F.col("tweet_id").alias("_l"), "top", "done")
    woken = lookup_join(woken, "_for", label, "_l", hot_rows=hot_rows).select("tweet_id", "top", "done", F.lit(True).alias("reshare"))
    rows = cut_lineage(labels.unionByName(woken))
    reshares = rows.where("reshare")
    put(rows.withColumn("epoch", F.lit(epoch).cast("long")), f"{out}/nodes", "tweet_id", name, buckets)
    put(reshares.where("NOT done AND top IS NOT NULL").select("tweet_id", "top"), f"{out}/waiting", "top", name, buckets)
    (reshares.where("done").groupBy(F.col("top").alias("root_id")).agg(F.count(F.lit(1)).alias("n_retweets"))
     .write.mode("overwrite").parquet(f"{out}/counts/delivery={name}"))


def current_roots(spark: SparkSession, out: str) -> DataFrame:
    """``(tweet_id, root_id)`` of every reshare that has one (a reshare gets
    its root once)."""
    return everything(spark, f"{out}/nodes", NODES).where("reshare AND done").select("tweet_id", F.col("top").alias("root_id"))


def current_root_counts(spark: SparkSession, out: str) -> DataFrame:
    """A6 kept up by epoch: the sum of what each epoch added to each root."""
    return everything(spark, f"{out}/counts", COUNTS).groupBy("root_id").agg(F.sum("n_retweets").alias("n_retweets"))
