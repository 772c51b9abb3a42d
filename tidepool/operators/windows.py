"""Per-day caps.

Both are ``row_number() <= limit`` over a day partition, a shape Spark plans
as a partial ``WindowGroupLimit`` before the shuffle and a final one after:
a day holding a third of all rows sends at most ``limit`` rows per map
task, never the whole day, to the reducer. Spark does so for small limits
only (``GROUP_LIMIT``, its default setting); for larger ones the rows of a
day are first ranked in ``SALTS`` parts, and at most ``limit`` of each part
meet in the day's final ranking.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tidepool.functions.dates import utc_day

GROUP_LIMIT, SALTS = 1000, 64


def _day(df: DataFrame, ts_col: str):
    """UTC day of an instant; the written day of any other time."""
    return utc_day(ts_col) if isinstance(df.schema[ts_col].dataType, TimestampType) else F.to_date(F.col(ts_col))


def cap_per_day(df: DataFrame, ts_col: str, n: int, tie: str, newest_first: bool = False) -> DataFrame:
    """The first n rows of each day by ``(ts, tie)`` (a search API
    pages newest first: ``newest_first=True``)."""
    order = [F.col(ts_col), F.col(tie)]
    if newest_first:
        order = [c.desc() for c in order]
    w = Window.partitionBy(_day(df, ts_col)).orderBy(*order)
    if n > GROUP_LIMIT:
        part = Window.partitionBy(_day(df, ts_col), F.pmod(F.xxhash64(ts_col, tie), F.lit(SALTS))).orderBy(*order)
        df = df.withColumn("_rn", F.row_number().over(part)).where(F.col("_rn") <= n).drop("_rn")
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def cap_pages_per_day(df: DataFrame, ts_col: str, page_size: int, n: int, tie: str,
                      newest_first: bool = False) -> DataFrame:
    """Whole pages of ``page_size`` rows per day, taken while the day's
    running total is below n (the last page may overshoot n)."""
    keep = math.ceil(n / page_size) * page_size
    return cap_per_day(df, ts_col, keep, tie, newest_first)
