"""Rows kept first-per-key by delivery, with a Bloom filter for each delivery
and hash bucket (K1, S8, T2).

Keys without an order in time (addresses, random ids) defeat the min/max
statistics of stored files: an append has to look at every key ever stored.
Here the keys of a new delivery are tested against the filters first; only
the files of a delivery and bucket that may hold one of them are read, and
only their keys go into the exact anti join. A filter never misses a key, so
the result is exact; a key it suspects wrongly (about one in 10,000 a filter)
costs a read.

A filter takes three to six bytes a key, in blocks of 4 KB, so it pays for keys
much longer than that. A key is tested against the one block a delivery
and bucket has for it: tests grow with keys times deliveries. Blocks come in
powers of two a bucket, so that all of them are found by one equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators import key_buckets as kb
from tidepool.operators.keyed import first_per_key, has_key

BITS = 24  # of a filter for a key, at least; up to twice as many, as blocks are doubled
HASHES = 6
BLOCK = 32768  # bits of what bitmap_construct_agg builds
FILTER = "bucket int, blocks long, block long, bits binary"


def _block(key: str, blocks: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit("block")), F.col(blocks))


def _bit(key: str, i: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(BLOCK))


def _set(bits: str, at: Column) -> Column:
    """Whether a bit of a bitmap is set: bit p lies in byte p / 8, at p % 8."""
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.bit_get(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1


def write_filters(keys: DataFrame, path: str, delivery: str, buckets: int = kb.BUCKETS) -> None:
    """Filters of the distinct, non-null ``keys`` (one column) of ``delivery``,
    which replace those it had."""
    key = keys.columns[0]
    own = keys.withColumn("bucket", kb.bucket_of(key, buckets))
    blocks = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.lit(1.0), F.count(F.lit(1)) * BITS / BLOCK)))).cast("long")
    sizes = own.groupBy("bucket").agg(blocks.alias("blocks"))  # at most one row a bucket
    spots = own.join(F.broadcast(sizes), "bucket").select(
        "bucket", "blocks", _block(key, "blocks").alias("block"), F.explode(F.array(*[_bit(key, i) for i in range(HASHES)])).alias("at"))
    (spots.groupBy("bucket", "blocks", "block").agg(F.bitmap_construct_agg("at").alias("bits"))
     .write.mode("overwrite").parquet(f"{path}/delivery={delivery}"))


def suspects(keys: DataFrame, path: str, buckets: int = kb.BUCKETS, without: str | None = None) -> DataFrame:
    """(key, unit) of the distinct ``keys`` (one column) that a filter of
    ``unit`` ('delivery/bucket') may hold; every stored key is among them."""
    spark, key = keys.sparkSession, keys.columns[0]
    none = keys.select(key, F.lit("").alias("unit")).limit(0)
    if not kb._there(spark, path):
        return none
    filters = spark.read.schema(FILTER + ", delivery string").parquet(path)
    if without is not None:
        filters = filters.where(F.col("delivery") != without)
    sizes = [r[0] for r in filters.select("blocks").distinct().collect()]  # powers of two: at most 63
    if not sizes:
        return none
    probes = (keys.withColumn("bucket", kb.bucket_of(key, buckets))
              .withColumn("blocks", F.explode(F.array(*[F.lit(s).cast("long") for s in sorted(sizes)])))
              .withColumn("block", _block(key, "blocks")))
    held = F.lit(True)
    for i in range(HASHES):
        held = held & _set("bits", _bit(key, i))
    return (probes.join(filters, ["bucket", "blocks", "block"]).where(held)
            .select(key, F.concat_ws("/", "delivery", "bucket").alias("unit")))


def append_filtered(batch: DataFrame, path: str, key: str, order: list[str], delivery: str,
                    buckets: int = kb.BUCKETS) -> dict[str, int]:
    """K1: store as ``delivery`` the rows of ``batch`` whose key no other delivery
    holds, the first per key by ``order``; rows without a key are left out. A
    delivery that is written again replaces itself, so a retried epoch
    changes nothing. Returns how many (delivery, bucket) units were read."""
    spark = batch.sparkSession
    first = first_per_key(batch.where(has_key([key])), [key], order).persist()
    maybe = suspects(first.select(key), f"{path}/filters", buckets, without=delivery).persist()
    units = [r[0] for r in maybe.select("unit").distinct().collect()]  # at most one a folder of the table
    new = first
    if units:
        unit = [T.StructField("delivery", T.StringType()), T.StructField("bucket", T.IntegerType())]
        held = (spark.read.schema(T.StructType([batch.schema[key], *unit])).parquet(f"{path}/rows")
                .where(F.concat_ws("/", "delivery", "bucket").isin(units)).select(key))
        again = maybe.select(key).distinct().join(held, key, "left_semi")
        new = first.join(again, key, "left_anti").select(*batch.columns)
    kb.put(new, f"{path}/rows", key, delivery, buckets)
    stored = spark.read.schema(batch.schema).parquet(f"{path}/rows/delivery={delivery}")
    write_filters(stored.select(key), f"{path}/filters", delivery, buckets)
    maybe.unpersist()
    first.unpersist()
    return {"units_read": len(units)}


def stored_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of all deliveries."""
    return kb.everything(spark, f"{path}/rows", schema)
