"""Operator 12: stateful streaming exact deduplication. DataFrame functions
and Structured Streaming only.

Texts are equal when they are identical after deleting every space, tab, line
feed, vertical tab, form feed and carriage return. Two streams run over the
landed files and stop when these are read; started again with the same folder,
they go on with files that have arrived since:

1. ``fingerprints``: each row's digest, stable identifier, length and content
   locator (file and row in it), appended by Spark's exactly-once file sink;
2. ``groups``: state keyed by digest in the RocksDB store, on disk, without a
   watermark, so that nothing expires. It retains for each digest the number
   of rows and the row that stays (most code points, then smallest id, then
   first locator). Rows of a task are combined before the shuffle, so a hot
   text is one row a task. Each epoch writes the digests it touched into a
   folder of its own; a retried epoch replaces that folder.

A digest that is held by more than one row is a hit: the normalised texts of
its rows, found by their locators, are compared in full, by the smallest and
largest of each digest (combined in the tasks first). Where they are not the
same text the rows are grouped by the text itself instead.

Defined cases: a null text counts as empty, and all empty texts are equal;
null ids come after all others; of rows with equal id, length and text the one
with the first locator is kept; an empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.shared import written
from tidepool.operators.skew import lookup_join
from tidepool.session import scratch_path

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# read when a query starts; no room is set aside for logs before they are written
STATE = {"spark.sql.streaming.stateStore.providerClass": STORE,
         "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}
BLANKS = " \t\n\x0b\f\r"
LOCATORS = 200_000  # (file, row, digest) that may be broadcast, some 40 MB; more are shuffled


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def sha256(text: Column) -> Column:
    """Digest of a text's UTF-8 bytes, as bytes."""
    return F.unhex(F.sha2(text, 256))


def _rows(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """(digest, sha, doc_id, n_chars, file, at) of every document."""
    text = normalised(F.col(f"`{text_col}`"))
    return docs.select(digest(text).alias("digest"), F.sha2(text, 256).alias("sha"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("n_chars"),
                       F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))


def _stays() -> Column:
    """Sorts first: the row that stays."""
    return F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "at")


def _ended(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def ingest(spark: SparkSession, source: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
           digest: Callable[[Column], Column] = sha256) -> None:
    """Take up the Parquet files of ``source`` (a folder or a file) that are new since the last
    call with this ``folder`` (in the shared checkpoint folder)."""
    source = source.rstrip("/")
    schema = spark.read.parquet(source).schema
    # as a pattern, so that one file is a source as well as a folder
    arrived = _rows(spark.readStream.schema(schema).parquet(f"{source[:-1]}[{source[-1]}]"), id_col, text_col, digest)
    _ended(arrived.writeStream.format("parquet").option("path", f"{folder}/fingerprints")
           .option("checkpointLocation", f"{folder}/progress/fingerprints").trigger(availableNow=True).start())
    prints = spark.readStream.schema(arrived.schema).parquet(f"{folder}/fingerprints")
    state = prints.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.min(_stays()).alias("stays"))

    def keep(touched: DataFrame, epoch: int) -> None:
        touched.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{folder}/groups/{epoch:08d}")

    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        _ended(state.writeStream.outputMode("update").foreachBatch(keep)
               .option("checkpointLocation", f"{folder}/progress/groups").trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def groups(spark: SparkSession, folder: str) -> DataFrame:
    """(digest, group_size, stays) as of the last epoch that touched each digest."""
    wrote = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/groups")
    last = wrote.groupBy("digest").agg(F.max_by(F.struct("group_size", "stays"), "epoch").alias("g"))
    return last.select("digest", "g.group_size", "g.stays")


def _contents(spark: SparkSession, source: str, text_col: str, rows: DataFrame, n: int) -> DataFrame:
    """``rows`` (n of them, with columns file and at) with their normalised texts."""
    held = spark.read.parquet(source).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"),
                                             normalised(F.col(f"`{text_col}`")).alias("content"))
    return held.join(F.broadcast(rows) if n <= LOCATORS else rows, ["file", "at"])


def _picked(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size",
                       ((F.col("file") == F.col("stays.file")) & (F.col("at") == F.col("stays.at"))).alias("kept"),
                       F.col("sha").alias("text_sha256"))


def result(spark: SparkSession, source: str, folder: str, text_col: str = "text") -> DataFrame:
    """One row a document taken up so far: doc_id, keep_id, group_size, kept,
    text_sha256."""
    state = written(groups(spark, folder), "groups").withColumnRenamed("digest", "held")
    prints = spark.read.parquet(f"{folder}/fingerprints")
    hits = state.where("group_size > 1").select("held")
    n = state.agg(F.sum(F.when(F.col("group_size") > 1, F.col("group_size")))).first()[0] or 0
    again = lookup_join(prints.select("digest", "file", "at"), "digest", hits, "held").drop("held")
    texts = _contents(spark, source, text_col, again, n).groupBy("digest").agg(F.min("content").alias("lo"), F.max("content").alias("hi"))
    odd = written(texts.where("lo <> hi").select(F.col("digest").alias("held")), "differing")
    if not odd.count():
        return _picked(lookup_join(prints, "digest", state, "held"))
    alike = lookup_join(prints, "digest", odd, "held", how="left_anti")
    unlike = written(_contents(spark, source, text_col, lookup_join(prints, "digest", odd, "held", how="left_semi"), n), "unlike")
    by_text = unlike.groupBy("content").agg(F.count(F.lit(1)).alias("group_size"), F.min(_stays()).alias("stays"))
    return _picked(lookup_join(alike, "digest", state, "held")).unionByName(
        _picked(lookup_join(unlike, "content", by_text.withColumnRenamed("content", "held"), "held")))


def exact_duplicates(spark: SparkSession, source: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                     digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``ingest`` into ``folder`` (a new one if none is given), then ``result``."""
    folder = folder or scratch_path(spark, "llm/exact_dedup")
    ingest(spark, source, folder, id_col, text_col, digest)
    return result(spark, source, folder, text_col)
