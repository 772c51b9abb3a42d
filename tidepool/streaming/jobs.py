"""Structured Streaming jobs.

Every job keeps its progress in a checkpoint location under the shared
checkpoint folder (T6: a stopped job resumes where it was), writes through
``foreachBatch`` so each micro-batch can run keyed batch operators (K1,
J9) against what is already stored, and runs with any trigger; the checks
use ``availableNow`` so a stream over landed files equals its batch twin.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.keyed import append_new
from tidepool.operators.parse import parse_tweet_v2, split_valid
from tidepool.operators.predicates import match_rules


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written. Only a missing path, or a folder without
    data files, counts as no table; any other fault is raised."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def append_keyed(batch: DataFrame, path: str, keys: list[str], order: list[str]) -> None:
    """K1 against a Parquet table: append only rows whose key is new (first
    per key within the batch). Only the key columns of the stored table are
    read, and only inside the batch's key range: the range predicate reaches
    the Parquet scan, so row groups whose min/max statistics miss the batch
    (time-ordered ids: all but the recent ones) are skipped."""
    spark = batch.sparkSession
    if _exists(spark, path):
        stored = spark.read.parquet(path).select(*keys)
        bounds = batch.agg(*[F.min(k).alias(f"lo_{k}") for k in keys],
                           *[F.max(k).alias(f"hi_{k}") for k in keys]).collect()[0]
        for k in keys:
            lo, hi = bounds[f"lo_{k}"], bounds[f"hi_{k}"]
            if lo is not None:
                stored = stored.where(F.col(k).between(F.lit(lo), F.lit(hi)))
        new = append_new(batch, stored, keys, order)
    else:
        new = append_new(batch, batch.limit(0).select(*keys), keys, order)
    new.write.mode("append").parquet(path)


def classify_stream(raw: DataFrame, rules: list[str] | None = None) -> DataFrame:
    """v2 envelopes -> flat rows with ``kind``; malformed rows and rows
    failing the rules are dropped."""
    valid, _ = split_valid(parse_tweet_v2(raw))
    return match_rules(valid, rules) if rules else valid


def stream_split(raw: DataFrame, out: str, checkpoint: str, rules: list[str] | None = None, order: str = "created_at",
                 trigger: dict | None = None):
    """F10 on a stream of v2 envelopes: valid rows (of the rules, if given) go
    to the keyed tables as in ``stream_ingest``; rejects are kept with their
    reason and how many rows had each status is counted. An epoch's rejects and
    counts are folders of its own, which a retried epoch writes again. Counts
    are observed while the epoch's rows are written, not by a pass of their own."""
    from pyspark.sql import Observation

    from tidepool.operators.parse import REJECT_REASONS, reject_reason

    def _sink(batch: DataFrame, epoch: int):
        spark = batch.sparkSession
        status = F.coalesce(reject_reason(batch), F.lit("valid"))
        seen = Observation()
        # one pass over the envelopes: all rows with their status, counted as they are written
        tagged = batch.withColumn("status", status).observe(
            seen, *[F.count_if(F.col("status") == s).alias(s) for s in ("valid", *REJECT_REASONS)])
        path = f"{out}/parsed/epoch={epoch}"
        tagged.write.mode("overwrite").partitionBy("status").parquet(path)
        counts = [(s, n) for s, n in seen.get.items() if n]
        spark.createDataFrame(counts, "status string, n long").coalesce(1).write.mode("overwrite").parquet(f"{out}/counts/epoch={epoch}")
        if any(s == "valid" for s, _ in counts):
            valid = spark.read.schema(batch.schema).parquet(f"{path}/status=valid").drop("_corrupt_record")
            valid = match_rules(valid, rules) if rules else valid
            for kind, name in (("regular", "regular"), ("retweet", "retweets")):
                append_keyed(valid.where(F.col("kind") == kind), f"{out}/{name}", ["tweet_id"], [order, "tweet_id"])

    w = parse_tweet_v2(raw).writeStream.foreachBatch(_sink).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def status_counts(spark: SparkSession, out: str) -> DataFrame:
    """``(status, n)`` over the epochs of ``stream_split``."""
    if not _exists(spark, f"{out}/counts"):
        return spark.createDataFrame([], "status string, n long")
    return spark.read.parquet(f"{out}/counts").groupBy("status").agg(F.sum("n").alias("n"))


def stream_rejects(spark: SparkSession, out: str, schema) -> DataFrame:
    """The rejected rows of ``stream_split`` with their ``status`` and epoch;
    ``schema`` is that of the parsed rows."""
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    if not _exists(spark, f"{out}/counts"):
        return spark.createDataFrame([], StructType([*schema.fields, StructField("epoch", IntegerType()), StructField("status", StringType())]))
    full = StructType([*schema.fields, StructField("epoch", IntegerType()), StructField("status", StringType())])
    return spark.read.schema(full).parquet(f"{out}/parsed").where("status <> 'valid'")


def stream_ingest(rows: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                  order: str = "created_at", archive: DataFrame | None = None):
    """Split a stream of classified tweets into the ``regular`` and
    ``retweets`` tables; first write wins per ``tweet_id`` across batches.

    Without ``archive`` the batch's own retweets and regular tweets are
    stored and replies skipped. With ``archive`` (known tweets: ``tweet_id,
    parent_tweet_id, kind`` and the stored columns) each micro-batch runs the
    ingest closure (J11) from its tweets: retweet chains are saved up to the
    first non-retweet, replies are followed to the regular tweet they answer,
    which is saved. The walk goes over the archive, the batch itself and
    every tweet an earlier batch brought (their edges are kept in
    ``{out}/seen``), so tweets that no archive holds are stored too. A stream
    of bare ids (no ``kind`` column) only walks the archive."""
    walk_view = None
    if archive is not None:
        from tidepool.operators.chains import cut_lineage, ingest_closure, prepare_archive
        walk_view = prepare_archive(archive)  # once, shared by every micro-batch

    def _walk(batch: DataFrame) -> DataFrame:
        spark, view, source = batch.sparkSession, walk_view, archive
        edge = ["tweet_id", "parent_tweet_id", "kind"]
        if set(edge) <= set(batch.columns):
            seen = f"{out}/seen"
            fresh = batch.dropDuplicates(["tweet_id"]).join(archive.select("tweet_id"), "tweet_id", "left_anti")
            append_keyed(fresh.select(*edge), seen, ["tweet_id"], ["tweet_id"])
            known = spark.read.parquet(seen)
            view = walk_view.unionByName(known.select(F.col("tweet_id").alias("_aid"), F.col("parent_tweet_id").alias("_par"),
                                                      F.col("kind").alias("_kind")))
            source = archive.unionByName(fresh, allowMissingColumns=True)
        reached = ingest_closure(batch.select("tweet_id"), view)
        return cut_lineage(source.join(reached, "tweet_id", "inner").withColumn(
            "kind", F.when(F.col("saved_to") == "retweets", "retweet").otherwise("regular")).drop("saved_to"))

    def _sink(batch: DataFrame, epoch: int):
        batch = batch.persist()
        rows_ = batch if archive is None else _walk(batch)
        append_keyed(rows_.where("kind = 'regular'"), f"{out}/regular", ["tweet_id"], [order, "tweet_id"])
        append_keyed(rows_.where("kind = 'retweet'"), f"{out}/retweets", ["tweet_id"], [order, "tweet_id"])
        batch.unpersist()

    w = rows.writeStream.foreachBatch(_sink).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def stream_dedup(rows: DataFrame, key: str, order: list[str], out: str, checkpoint: str,
                 delay: str | None = None, ts_col: str | None = None, trigger: dict | None = None):
    """Skip rows whose key was already saved. With ``delay``, Spark's
    bounded-state ``dropDuplicatesWithinWatermark`` drops repeats inside
    the delay first; the keyed append (K1) then enforces the full history."""
    if delay:
        rows = rows.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([key])

    def _sink(batch: DataFrame, epoch: int):
        batch = batch.persist()  # read for its key range and again for the write
        append_keyed(batch, out, [key], order)
        batch.unpersist()

    w = rows.writeStream.foreachBatch(_sink).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def stream_first_seen(rows: DataFrame, key: str, order: list[str], out: str, checkpoint: str,
                      buckets: int | None = None, trigger: dict | None = None):
    """T2 for keys without an order in time: the first row of every key over all
    epochs, by ``order`` inside an epoch. An epoch is a delivery of
    ``append_filtered``: stored keys are read only where a filter suspects one,
    and a retried epoch writes its own delivery again. Read the result with
    ``key_filter.stored_rows``."""
    from tidepool.operators import key_buckets, key_filter

    def _sink(batch: DataFrame, epoch: int):
        key_filter.append_filtered(batch, out, key, order, f"{epoch:08d}", buckets or key_buckets.BUCKETS)

    w = rows.writeStream.foreachBatch(_sink).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def daily_counts(rows: DataFrame, ts_col: str, out: str, checkpoint: str,
                 watermark: str | None = None, trigger: dict | None = None):
    """T4: rows per one-day tumbling window. Without a watermark the whole
    (small: one row per day) result is rewritten each batch (complete mode);
    with one, closed days are written once, into a folder of their epoch
    (``out/epoch=N``: a retried epoch replaces its own folder), and state is
    dropped."""
    from pyspark.sql.types import TimestampNTZType
    from tidepool.functions.dates import utc_day
    keyed = rows
    if watermark:
        keyed = keyed.withWatermark(ts_col, watermark)
    agg = keyed.groupBy(F.window(ts_col, "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    # tumbling windows are aligned to the epoch (UTC days); name them so
    ntz = isinstance(rows.schema[ts_col].dataType, TimestampNTZType)
    day = F.date_format(F.col("w.start"), "yyyy-MM-dd") if ntz else utc_day(F.col("w.start"))
    agg = agg.select(day.alias("day"), "n")

    def _sink(batch: DataFrame, epoch: int):
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}" if watermark else out)

    mode = "append" if watermark else "complete"
    w = agg.writeStream.outputMode(mode).foreachBatch(_sink).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


BUCKET_BYTES = 256 << 20  # of the base, for each key bucket of a versioned table
LEAST_BUCKETS = 64


def _buckets(spark: SparkSession, base_path: str) -> int:
    """Key buckets of a versioned table. They follow the bytes of its base,
    which no update changes, so the number stays for the life of the table."""
    base = spark._jvm.org.apache.hadoop.fs.Path(f"{base_path}/v={0:08d}")
    size = base.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(base).getLength()
    return max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _committed(spark: SparkSession, base_path: str) -> dict[int, list[int]]:
    """Versions whose write has committed, with the key buckets they hold.
    Read faults are raised."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(base_path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out = {}
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(path(st.getPath(), "_SUCCESS")):
            parts = [x.getPath().getName() for x in fs.listStatus(st.getPath())]
            out[int(name[2:])] = [int(x.split("=")[1]) for x in parts if x.startswith("keybucket=")]
    return out


def _state(spark: SparkSession, base_path: str, key: str, below: int | None = None) -> DataFrame:
    """Rows of a versioned table as of the versions under ``below``: each
    bucket from the newest version that holds it, the others from the base."""
    owner = {}
    for v, buckets in sorted(_committed(spark, base_path).items()):
        if below is None or v < below:
            owner.update(dict.fromkeys(buckets, v))
    rows = spark.read.parquet(f"{base_path}/v={0:08d}")
    if owner:
        newer = spark.read.parquet(*[f"{base_path}/v={v:08d}/keybucket={b}" for b, v in sorted(owner.items())])
        rows = rows.where(~_bucket(key, _buckets(spark, base_path)).isin(sorted(owner))).unionByName(newer, allowMissingColumns=True)
    return rows


def current_table(spark: SparkSession, base_path: str, key: str) -> DataFrame:
    """The versioned table as it is now."""
    return _state(spark, base_path, key).drop("_seq")


def stream_update(updates: DataFrame, base_path: str, key: str, cols: list[str], seq: list[str],
                  checkpoint: str, trigger: dict | None = None):
    """T5: apply each micro-batch of updates to a keyed table (J9) whose base
    is ``base_path/v=00000000``. Epoch N writes version N + 1, which holds
    only the key buckets it touches, from the newest committed versions below
    N + 1. So a retried epoch rewrites its own folder from the same input and
    never reads it. The number of buckets follows the size of the base, and the
    rebalance hint lets AQE split a large bucket over tasks and files. The sequence of the update is stored with the row
    (``_seq``): an older update that arrives later changes nothing, and the
    stream ends equal to its batch twin. One checkpoint belongs to a table."""
    def _sink(batch: DataFrame, epoch: int):
        spark, version = batch.sparkSession, epoch + 1
        if any(v > version for v in _committed(spark, base_path)):
            raise ValueError(f"{base_path} has versions after {version}: it belongs to another checkpoint")
        latest = batch.groupBy(key).agg(
            F.max_by(F.struct(*cols), F.struct(*seq, *cols)).alias("_new"), F.max(F.struct(*seq)).alias("_at")).persist()
        bucket = _bucket(key, _buckets(spark, base_path))
        touched = [r[0] for r in latest.select(bucket).distinct().collect()]  # at most one row a bucket
        if touched:
            state = _state(spark, base_path, key, below=version).where(bucket.isin(touched))
            if "_seq" not in state.columns:
                state = state.withColumn("_seq", F.lit(None).cast(latest.schema["_at"].dataType))
            # of equal sequences the greatest values, as in the batch
            newer = F.col("_at").isNotNull() & (F.col("_seq").isNull() | (F.struct("_at", "_new") > F.struct("_seq", F.struct(*cols))))
            out = [F.when(newer, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
                   for c in state.columns if c != "_seq"]
            (state.join(latest, key, "left").select(*out, F.when(newer, F.col("_at")).otherwise(F.col("_seq")).alias("_seq"))
             .withColumn("keybucket", bucket).hint("rebalance", "keybucket")
             .write.partitionBy("keybucket").mode("overwrite").parquet(f"{base_path}/v={version:08d}"))
        latest.unpersist()

    w = updates.writeStream.foreachBatch(_sink).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def parquet_stream(spark: SparkSession, folder: str, file_glob: str, schema=None) -> DataFrame:
    """The Parquet tables of a folder that the glob picks as a stream. A table
    is a file, or a folder of files, which may be partitioned."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{file_glob}")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    if any(f.isDirectory() for f in found):  # the names of the files within are free: a filter by name would miss them
        path, only = p.toString(), {}
    else:
        path, only = folder, {"pathGlobFilter": file_glob}
    if schema is None:
        schema = spark.read.options(**only).parquet(path).schema
    return spark.readStream.schema(schema).options(**only).parquet(path)
