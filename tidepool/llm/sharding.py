"""Operator 3: contiguous shards of nearly equal bytes.

Rows are dealt by range of the order columns and that layout is written
once. Per-partition totals (one row a partition) give every partition its
global byte and row offset; a running sum inside the partition adds the
rest. The global prefix before a row, divided by the target total / shards,
is its shard: shards are contiguous in the order and differ by less than
two rows' bytes. Only narrow rows (keys, size, checksum) are shuffled.

Defined cases: a null text has no bytes (size 1); ties in the order columns
are broken by size and checksum and then by position in the input, so rows
that repeat are spread as well; an empty table gives no rows; extra columns
are not read. With fewer bytes than shards some shards stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.shared import pick, written


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def utf8_crc32(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 text; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long")


def shard_by_bytes(rows: DataFrame, order: list[str], size: str, shards: int = 16) -> DataFrame:
    """``rows`` (narrow, any columns) with ``shard`` (0 .. shards - 1,
    contiguous in ``order``) and ``slot`` (gapless from 0 in each shard)."""
    placed = written(rows.withColumn("_at", F.monotonically_increasing_id())
                     .repartitionByRange(*[F.col(c) for c in order], "_at")
                     .withColumn("_part", F.spark_partition_id()), "shard-layout")
    totals = placed.groupBy("_part").agg(F.sum(size).alias("_bytes"), F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select("_part", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_b0"),
                            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_r0"),
                            F.sum("_bytes").over(every).alias("_all"))
    here = Window.partitionBy("_part").orderBy(*order, "_at")
    running = (placed.withColumn("_run", F.sum(size).over(here.rowsBetween(Window.unboundedPreceding, 0)) - F.col(size))
               .withColumn("_row", F.row_number().over(here) - 1)
               .join(F.broadcast(offsets), "_part"))  # one row a partition
    # exact integers: prefix * shards may pass 2^63 beyond 5 * 10^17 bytes
    shard = F.expr(f"cast(div(cast(_b0 + _run as decimal(28,0)) * {int(shards)}, _all) as int)")
    marked = running.withColumn("shard", shard).withColumn("_index", F.col("_r0") + F.col("_row"))
    marked = written(marked.drop("_b0", "_r0", "_all", "_run", "_row", "_part", "_at"), "shard-index")
    first = marked.groupBy("shard").agg(F.min("_index").alias("_first"))
    return (marked.join(F.broadcast(first), "shard")  # one row a shard
            .withColumn("slot", F.col("_index") - F.col("_first")).drop("_index", "_first"))


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every document."""
    base = pick(docs, {"doc_id": id_col, "text": text_col})
    narrow = base.select("doc_id", utf8_size(F.col("text")).alias("size"), utf8_crc32(F.col("text")).alias("text_crc32"))
    return shard_by_bytes(narrow, ["doc_id", "size", "text_crc32"], "size", shards)


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """The documents (unique ids) as one folder a shard, in slot order within
    each file."""
    (docs.join(placed.select(F.col("doc_id").alias(id_col), "shard", "slot"), id_col)
     .repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
