"""J11 over an edge index: the archive's edges are written once in hash buckets
of their id, and each hop of the ingest walk reads only the buckets its
frontier touches. Where the walk needs a post that the index does not hold, it
is parked there, and taken up again when a later delivery brings that post."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.chains import COMPACT_EVERY, FRONTIER_ROWS, cut_lineage, follow
from tidepool.operators.key_buckets import BUCKETS, everything, probe, put

EDGES = "_aid string, _par string, _kind string"
PARKED = "fid string, phase string"
SAVED = "tweet_id string, saved_to string"


def index_edges(archive: DataFrame, path: str, delivery: str, buckets: int = BUCKETS) -> DataFrame:
    """Add the edges ``(tweet_id, parent_tweet_id, kind)`` as ``delivery``:
    all different edges of each id that no other delivery holds (NULL ids are
    no posts). Returns the ids added, ``fid``."""
    spark = archive.sparkSession
    rows = archive.where("tweet_id IS NOT NULL").select(F.col("tweet_id").alias("_aid"), F.col("parent_tweet_id").alias("_par"),
                                                        F.col("kind").alias("_kind"))
    rows = cut_lineage(rows.distinct())
    held = probe(spark, path, EDGES, "_aid", rows.select("_aid"), buckets, without=delivery)
    new = cut_lineage(rows.join(held.select("_aid"), "_aid", "left_anti"))
    put(new, path, "_aid", delivery, buckets)
    return new.select(F.col("_aid").alias("fid")).distinct()


def walk_indexed(frontier: DataFrame, path: str, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """The ingest walk (``chains.ingest_closure``) from ``(fid, phase)`` rows:
    what it saves ``(tweet_id, saved_to)``, and where it had to stop for want
    of a post ``(fid, phase)``."""
    spark = frontier.sparkSession
    frontier = cut_lineage(frontier.where("fid IS NOT NULL").select("fid", "phase").distinct())
    seen, saved, missing = [frontier], [], []
    while n := frontier.count():
        edges = probe(spark, path, EDGES, "_aid", frontier.select("fid"), buckets)
        near = F.broadcast(frontier) if n <= FRONTIER_ROWS else frontier
        hit = cut_lineage(edges.join(near, F.col("fid") == F.col("_aid"), "inner"))
        out = follow(hit)
        saved.append(out.where("saved_to IS NOT NULL").select("tweet_id", "saved_to"))
        missing.append(frontier.join(hit.select("fid").distinct(), "fid", "left_anti"))
        onward = out.where("next_id IS NOT NULL").select(F.col("next_id").alias("fid"), F.col("next_phase").alias("phase")).distinct()
        frontier = cut_lineage(onward.join(reduce(DataFrame.unionByName, seen), ["fid", "phase"], "left_anti"))
        seen.append(frontier)
        if len(seen) > COMPACT_EVERY:  # long chains: keep plans small
            seen, saved, missing = ([cut_lineage(reduce(DataFrame.unionByName, x))] for x in (seen, saved, missing))
    if not saved:
        return spark.createDataFrame([], SAVED), spark.createDataFrame([], PARKED)
    return reduce(DataFrame.unionByName, saved).distinct(), reduce(DataFrame.unionByName, missing)


def walk_delivery(spark: SparkSession, index: str, out: str, delivery: str, added: DataFrame | None,
                  seeds: DataFrame | None = None, buckets: int = BUCKETS) -> None:
    """Walk from ``seeds`` (``tweet_id``) and from the places where earlier
    walks are parked at one of the posts ``added`` (``fid``) to the index.
    What is saved and parked is written as ``delivery`` below ``out``."""
    front = [] if seeds is None else [seeds.select(F.col("tweet_id").alias("fid"), F.lit("R").alias("phase"))]
    if added is not None:
        waiting = probe(spark, f"{out}/parked", PARKED, "fid", added, buckets, without=delivery)
        front.append(waiting.join(added, "fid", "left_semi"))
    if not front:
        raise ValueError("neither seeds nor added posts")
    saved, parked = walk_indexed(reduce(DataFrame.unionByName, front), index, buckets)
    saved.write.mode("overwrite").parquet(f"{out}/saved/delivery={delivery}")
    put(parked, f"{out}/parked", "fid", delivery, buckets)


def saved_posts(spark: SparkSession, out: str) -> DataFrame:
    """Distinct ``(tweet_id, saved_to)`` of all deliveries."""
    return everything(spark, f"{out}/saved", SAVED).distinct()


def refresh_archive(archive: DataFrame, index: str, out: str, delivery: str, buckets: int = BUCKETS) -> None:
    """Add an archive's edges to the index and take up what waits for them."""
    added = index_edges(archive, index, delivery, buckets)
    walk_delivery(archive.sparkSession, index, out, delivery, added, buckets=buckets)
