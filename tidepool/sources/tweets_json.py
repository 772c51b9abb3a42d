"""Tweet JSON sources (S5) and the line stream.

Always an explicit schema; malformed lines land in ``_corrupt_record``
(PERMISSIVE), so one bad record never aborts a 100 TB scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.schemas import TWEET_V1, TWEET_V2


def _reader(spark: SparkSession, schema):
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record"))


def read_tweets_v1(spark: SparkSession, path: str) -> DataFrame:
    """Line-delimited v1.1 tweet objects."""
    return _reader(spark, TWEET_V1).json(path)


def read_tweets_v2(spark: SparkSession, path: str) -> DataFrame:
    """Line-delimited v2 envelopes ``{data, includes}``."""
    return _reader(spark, TWEET_V2).json(path)


def parse_json_column(df: DataFrame, col: str, version: int = 2) -> DataFrame:
    """Decode a JSON text column in place of reading files (e.g. a Kafka
    value): the top-level fields become columns, undecodable text is kept
    in ``_corrupt_record``."""
    schema = TWEET_V2 if version == 2 else TWEET_V1
    parsed = F.from_json(F.col(col), schema, {"mode": "PERMISSIVE",
                                              "columnNameOfCorruptRecord": "_corrupt_record"})
    return df.withColumn("_p", parsed).select(
        *[c for c in df.columns], *[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields])


def stream_tweets(spark: SparkSession, path: str, version: int = 2) -> DataFrame:
    """A directory of JSON-lines files as a stream; blank keep-alive
    lines produce no rows."""
    schema = TWEET_V2 if version == 2 else TWEET_V1
    return (spark.readStream.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
