"""Rows kept by key in hash buckets, so that a look-up reads only the buckets
its keys touch: plain Parquet, partitioned by delivery and bucket. A delivery
is written as a whole and replaces itself when it is written again, so a
retried epoch leaves a table as it was."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 256  # of a table, for its life; choose about table size / 1 GB


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def put(rows: DataFrame, path: str, key: str, delivery: str, buckets: int = BUCKETS) -> None:
    """Write ``rows`` as ``delivery``. The rebalance hint lets AQE split a
    bucket that one key fills and join small ones."""
    (rows.withColumn("bucket", bucket_of(key, buckets)).hint("rebalance", "bucket")
     .write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/delivery={delivery}"))


def probe(spark: SparkSession, path: str, schema: str, key: str, keys: DataFrame, buckets: int = BUCKETS,
          without: str | None = None) -> DataFrame:
    """Rows of the buckets that ``keys`` (one column) touch, of all deliveries
    but ``without``; not only rows of these keys."""
    name = keys.columns[0]
    touched = [r[0] for r in keys.where(F.col(name).isNotNull()).select(bucket_of(name, buckets)).distinct().collect()]  # at most ``buckets``
    if not touched or not _there(spark, path):
        return spark.createDataFrame([], schema)
    columns = T.StructType.fromDDL(schema)
    rows = spark.read.schema(T.StructType([*columns.fields, T.StructField("delivery", T.StringType()), T.StructField("bucket", T.IntegerType())]))
    rows = rows.parquet(path).where(F.col("bucket").isin(touched))
    if without is not None:
        rows = rows.where(F.col("delivery") != without)
    return rows.select(*columns.names)


def everything(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of all deliveries."""
    if not _there(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def _there(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
