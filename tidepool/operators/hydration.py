"""Resumable hydration (J3, T6): an ID list is cut once into slices of the key
range; each slice that is done has a row in a ledger. A run that was stopped
goes on with the slices that have none.

Slices are done in waves: one job a wave reads the archive once, between the
least and the greatest id of its slices (a range that reaches the scan, so a
sorted archive is read in part), and writes one folder a slice. Only then are
the wave's ledger rows written. Slices of a wave that was stopped before that
are written again in place, so no id is there twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "slice int, n_ids long, n_found long"


def plan_slices(ids: DataFrame, out: str, slices: int, key: str = "tweet_id") -> None:
    """Write the distinct ids (NULL is no id) with their slice, once: a folder
    that holds a plan keeps it, so a later run goes on with the same slices."""
    spark = ids.sparkSession
    if _done(spark, f"{out}/plan"):
        return
    ranged = ids.where(F.col(key).isNotNull()).select(key).distinct().repartitionByRange(slices, key)
    (ranged.withColumn("slice", F.spark_partition_id()).sortWithinPartitions(key)
     .write.partitionBy("slice").mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out}/plan"))


def _done(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """A row for each slice that is done: slice, n_ids, n_found."""
    if not _any(spark, f"{out}/ledger"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema("n_ids long, n_found long, slice int").parquet(f"{out}/ledger").select("slice", "n_ids", "n_found")


def open_slices(spark: SparkSession, out: str) -> list[int]:
    """Slices of the plan without a ledger row (one number a slice)."""
    if not _any(spark, f"{out}/plan"):
        return []
    plan = spark.read.parquet(f"{out}/plan")
    have = {r[0] for r in ledger(spark, out).select("slice").collect()}
    return sorted(r[0] for r in plan.select("slice").distinct().collect() if r[0] not in have)


def _any(spark: SparkSession, path: str) -> bool:
    """Whether a table holds any slice (one without rows is an empty folder)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and any(x.getPath().getName().startswith("slice=") for x in fs.listStatus(p))


def hydrate_slices(ids: DataFrame, archive: DataFrame, out: str, slices: int = 64, wave: int = 16, stop_after: int | None = None,
                   key: str = "tweet_id") -> int:
    """Hydrate the open slices of ``ids`` from ``archive`` (which holds an id
    once) into ``out``; returns how many were done. ``stop_after`` ends a run
    after that many slices, as a quota would. The records are
    ``hydrated(spark, out)``."""
    spark = ids.sparkSession
    plan_slices(ids, out, slices, key)
    todo = open_slices(spark, out)[:stop_after]
    for at in range(0, len(todo), wave):
        own = todo[at:at + wave]
        mine = spark.read.parquet(f"{out}/plan").where(F.col("slice").isin(own))
        lo, hi = mine.agg(F.min(key), F.max(key)).first()
        found = mine.join(archive.where(F.col(key).between(F.lit(lo), F.lit(hi))), key).select(*archive.columns, "slice")
        _replace(found, f"{out}/records")
        got = spark.read.schema(found.schema).parquet(f"{out}/records").where(F.col("slice").isin(own))
        rows = mine.groupBy("slice").agg(F.count(F.lit(1)).alias("n_ids")).join(
            got.groupBy("slice").agg(F.count(F.lit(1)).alias("n_found")), "slice", "left")
        _replace(rows.select("n_ids", F.coalesce("n_found", F.lit(0)).cast("long").alias("n_found"), "slice"), f"{out}/ledger")
    return len(todo)


def _replace(rows: DataFrame, path: str) -> None:
    """Write the slices of ``rows`` in place of what they held."""
    rows.write.partitionBy("slice").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def hydrated(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """The records of the slices in the ledger, with the given columns; those
    of a slice that has not reached the ledger do not count."""
    done = [r[0] for r in ledger(spark, out).select("slice").collect()]
    if not done:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, slice int").parquet(f"{out}/records").where(F.col("slice").isin(done))
    return rows.drop("slice")
