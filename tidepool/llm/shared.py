"""Helpers of the operators: written tables, checked broadcasts, folds."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.session import scratch_path

# Rows of a key-only frame that may be broadcast (about 32 MB of longs);
# beyond it the same join is shuffled.
BROADCAST_ROWS = 2_000_000


def session(df: DataFrame) -> SparkSession:
    return df.sparkSession


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and
    read back: cuts lineage, survives lost executors, evaluates once."""
    spark = session(df)
    path = scratch_path(spark, f"llm/{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def semi_join(df: DataFrame, key: str, ids: DataFrame, n_ids: int, extra: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids`` (columns ``key`` and, with
    ``extra``, others to attach; keys unique). ``n_ids`` is the counted size of
    ``ids``: up to ``BROADCAST_ROWS`` it is broadcast and ``df`` is only
    scanned, above that both sides are shuffled."""
    side = F.broadcast(ids) if n_ids <= BROADCAST_ROWS else ids
    return df.join(side, key, "inner" if extra else "left_semi")


def fold(key: Column, n: int) -> Column:
    """crc32 of the key's decimal text modulo n."""
    return F.crc32(key.cast("string").cast("binary")) % n


def pick(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Only the given columns, renamed to inner names that cannot clash."""
    return df.select(*[F.col(f"`{c}`").alias(a) for a, c in names.items()])


def block_pairs(df: DataFrame, group: list[str], size: str, member: str, block: int,
                lead: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Split groups of more than ``block`` members into blocks and repeat
    each member for every pair of blocks it belongs to, so that all pairs of
    members meet in some (group, _bi, _bj) of at most about 2 x block rows.
    Adds ``_bi <= _bj`` and the member's own block ``_b``."""
    n = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(lead(F.col(member)), n).cast("int")
    one = df.withColumn("_n", n).withColumn("_b", F.when(F.col("_n") <= 1, 0).otherwise(own))
    other = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    return (one.withColumn("_o", other)
            .withColumn("_bi", F.least("_b", "_o")).withColumn("_bj", F.greatest("_b", "_o"))
            .drop("_o", "_n"))


def with_scores(docs: DataFrame, text_col: str, score_col: str, score: Callable) -> DataFrame:
    """``docs``, all its columns, with a double column from ``score``, which
    yields (first row, rows, values) over slices of the text column. One pass,
    no shuffle; ``score_col`` must be a new name."""
    if score_col in docs.columns:
        raise ValueError(f"column {score_col} exists")
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for lo, n, values in score(batch.column(at)):
                part = batch.slice(lo, n)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values)], names=schema.names)

    return docs.mapInArrow(run, schema)


def new_name(docs: DataFrame, base: str) -> str:
    """A column name that ``docs`` does not have in any letter case."""
    have = {c.lower() for c in docs.columns}
    while base.lower() in have:
        base += "_"
    return base
