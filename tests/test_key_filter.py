"""Deliveries with key filters: exact for random keys, reading few files."""

import shutil

from pyspark.sql import functions as F

from tidepool.operators import key_filter as kf

SCHEMA = "key string, n long"


def _rows(spark, lo, hi):
    return spark.range(lo, hi).select(F.md5(F.col("id").cast("string")).alias("key"), F.col("id").alias("n"))


def _stored(spark, path):
    return sorted(map(tuple, kf.stored_rows(spark, path, SCHEMA).collect()))


def test_every_stored_key_is_suspected_and_few_others(spark, tmp_path):
    # 8 buckets of 5,000 keys take more than one block each
    path = str(tmp_path / "filters")
    kf.write_filters(_rows(spark, 0, 40000).select("key"), path, "a", 8)
    assert spark.read.parquet(path).agg(F.max("blocks")).first()[0] >= 4
    own = kf.suspects(_rows(spark, 0, 40000).select("key"), path, 8)
    assert own.select("key").distinct().count() == 40000
    assert kf.suspects(_rows(spark, 40000, 140000).select("key"), path, 8).count() < 100
    assert kf.suspects(_rows(spark, 0, 10).select("key"), path, 8, without="a").count() == 0


def test_appends_are_exact_and_read_only_suspected_units(spark, tmp_path):
    path = str(tmp_path / "t")
    for d in range(4):  # 32 units of new keys
        read = kf.append_filtered(_rows(spark, d * 500, d * 500 + 500), path, "key", ["n"], str(d), 8)
        assert read["units_read"] <= 2
    # one stored key, a hot new key, a row without key
    batch = _rows(spark, 3, 4).unionByName(spark.range(3000).selectExpr("'hot' AS key", "id + 7 AS n")).unionByName(
        spark.createDataFrame([(None, 1)], SCHEMA))
    assert kf.append_filtered(batch, path, "key", ["n"], "4", 8)["units_read"] <= 2
    want = sorted([*map(tuple, _rows(spark, 0, 2000).collect()), ("hot", 7)])
    assert _stored(spark, path) == want
    # everything again: nothing is new
    again = _rows(spark, 0, 2000).withColumn("n", F.col("n") - 1)
    assert kf.append_filtered(again, path, "key", ["n"], "5", 8)["units_read"] == 32
    assert _stored(spark, path) == want
    # an empty delivery, and a delivery after it
    assert kf.append_filtered(batch.limit(0), path, "key", ["n"], "6", 8)["units_read"] == 0
    kf.append_filtered(_rows(spark, 1990, 2010), path, "key", ["n"], "7", 8)
    assert _stored(spark, path) == sorted([*want, *map(tuple, _rows(spark, 2000, 2010).collect())])


def test_a_delivery_written_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    kf.append_filtered(_rows(spark, 0, 50), path, "key", ["n"], "0", 8)
    kf.append_filtered(_rows(spark, 30, 90), path, "key", ["n"], "1", 8)
    want = _stored(spark, path)
    shutil.rmtree(f"{path}/filters/delivery=1")  # stopped between rows and filters
    kf.append_filtered(_rows(spark, 30, 90), path, "key", ["n"], "1", 8)
    assert _stored(spark, path) == want == sorted(map(tuple, _rows(spark, 0, 90).collect()))
    kf.append_filtered(_rows(spark, 80, 95), path, "key", ["n"], "2", 8)
    assert _stored(spark, path) == sorted(map(tuple, _rows(spark, 0, 95).collect()))


def test_the_stream_keeps_the_first_row_of_a_key(spark, tmp_path):
    from tidepool.streaming.jobs import stream_first_seen
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    for rows in ([("b", 5), ("a", 2), ("a", 1), (None, 0)], [("a", 0), ("c", 9)], []):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream_first_seen(spark.readStream.schema(SCHEMA).parquet(src), "key", ["n"], out, ck, 4).awaitTermination()
    want = [("a", 1), ("b", 5), ("c", 9)]
    assert _stored(spark, out) == want
    shutil.rmtree(f"{ck}/commits")  # the last epoch runs again
    stream_first_seen(spark.readStream.schema(SCHEMA).parquet(src), "key", ["n"], out, ck, 4).awaitTermination()
    assert _stored(spark, out) == want
