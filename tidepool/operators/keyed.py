"""Keyed writes: insert-or-ignore, hydrate, update by key, orphans, dense
ids (K1, J2, J3, J9, J10, P17, W1, W4).

"First per key" and "latest per key" are aggregations (``min_by`` /
``max_by`` over a struct), so Spark combines them map-side and a hot key
costs one row per map task in the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidepool.operators.skew import lookup_join
from tidepool.session import checkpoint_dir


def _order_struct(order: list[str]):
    return F.struct(*[F.col(c) for c in order])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the one lowest in ``order`` (ties: lowest row
    overall, so the pick is deterministic)."""
    cols = list(df.columns)
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(_order_struct(order), F.struct(*cols))).alias("_r"))
    return picked.select("_r.*")


def has_key(keys: list[str]):
    """Rows whose key columns are all there."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def append_new(batch: DataFrame, existing: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """K1: rows of ``batch`` to append - first per key within the batch,
    and only keys not already stored (insert-or-ignore, no loss). The first per
    key is combined in the tasks before any shuffle, so a hot key is one row a
    task there and one row in the join. A row without a key (any key column
    NULL) cannot be told from others: it is never appended; ``without_key``
    gives these rows."""
    first = first_per_key(batch.where(has_key(keys)), keys, order)
    return first.join(existing.select(*keys), keys, "left_anti").select(*batch.columns)


def without_key(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` that ``append_new`` leaves out for want of a key."""
    return batch.where(~has_key(keys))


def new_by_key(batch: DataFrame, existing: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Same contract as K1, named after the article loader's URL test."""
    return append_new(batch, existing, keys, order)


def write_append(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, mode: str = "append"):
    """Append (or ``mode='overwrite'`` to replace) a table."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def retweet_ids(full: DataFrame, clean: DataFrame, lang: str = "en", key: str = "tweet_id") -> DataFrame:
    """IDs of the ``lang`` rows of the full set missing from the
    ``lang`` rows of the clean set (retweets). A left anti join: duplicate
    IDs of the full set are kept, unlike ``EXCEPT``."""
    f = full.where(F.col("lang") == lang).select(key)
    c = clean.where(F.col("lang") == lang).select(F.col(key).alias("_ck")).distinct()
    return lookup_join(f, key, c, "_ck", how="left_anti")


def hydrate(ids: DataFrame, archive: DataFrame, key: str = "tweet_id") -> DataFrame:
    """ID list -> full records; duplicate IDs hydrate once."""
    return ids.select(key).distinct().join(archive, key, "inner")


def unhydrated(ids: DataFrame, archive: DataFrame, key: str = "tweet_id") -> DataFrame:
    """IDs with no record (what a resumed run still has to do)."""
    return ids.select(key).distinct().join(archive.select(key), key, "left_anti")


def latest_per_key(updates: DataFrame, key: str, cols: list[str], seq: list[str]) -> DataFrame:
    """Latest update per key: greatest ``seq`` wins, of equal ones the greatest
    values."""
    agg = updates.groupBy(key).agg(
        F.max_by(F.struct(*[F.col(c) for c in cols]), _order_struct([*seq, *cols])).alias("_u"))
    return agg.select(key, *[F.col(f"_u.{c}").alias(c) for c in cols])


def update_by_key(base: DataFrame, updates: DataFrame, key: str, cols: list[str],
                  seq: list[str]) -> DataFrame:
    """``base`` with ``cols`` replaced by the latest update of each key;
    unmatched rows keep their values, update keys absent from ``base`` are
    ignored (an UPDATE, not an upsert)."""
    for c in cols:
        if c not in base.columns:
            raise ValueError(f"column {c} missing from base; use ensure_column first")
    latest = latest_per_key(updates, key, cols, seq).select(
        F.col(key), F.lit(True).alias("_matched"), *[F.col(c).alias(f"_new_{c}") for c in cols])
    j = base.join(latest, key, "left")
    out = [F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
           if c in cols else F.col(c) for c in base.columns]
    return j.select(*out)


def ensure_column(df: DataFrame, name: str, dtype: DataType | str) -> DataFrame:
    """Add ``name`` as NULLs when absent."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(None).cast(dtype))


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str | None = None) -> DataFrame:
    """Child rows whose foreign key has no parent row."""
    pk = pk or fk
    keys = parent.select(F.col(pk).alias("_pk")).distinct()
    return lookup_join(child, fk, keys, "_pk", how="left_anti")


def assign_ids(df: DataFrame, base: int, order: list[str], id_col: str = "article_id",
               num_partitions: int | None = None) -> DataFrame:
    """Dense ids ``base + 0..n-1`` in ``order`` (which must be unique).

    Range-partition and sort, then the row's position inside its partition
    comes from ``monotonically_increasing_id`` (partition index in the high
    bits). The sorted frame is written once to the shared checkpoint folder
    so both passes see the same partitions; per-partition row counts (one
    row per partition) give each partition's offset. No single-task window.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_df = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                 .withColumn("_mid", F.monotonically_increasing_id()))
    checkpoint_dir(spark)
    sorted_df = sorted_df.checkpoint(eager=True)
    part = F.shiftright(F.col("_mid"), 33)
    counts = sorted_df.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n")).collect()
    offsets, acc = {}, 0
    for r in sorted(counts, key=lambda r: r["_p"]):
        offsets[r["_p"]] = acc
        acc += r["_n"]
    if not offsets:
        return sorted_df.drop("_mid").withColumn(id_col, F.lit(None).cast("long"))
    off_map = F.create_map(*[x for p, o in offsets.items() for x in (F.lit(p), F.lit(o))])
    pos = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return sorted_df.withColumn(id_col, F.lit(base) + off_map[part] + pos).drop("_mid")


