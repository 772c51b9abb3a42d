"""Calendar of expected daily files (S11) and the days missing from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def expected_days(spark: SparkSession, month: str) -> DataFrame:
    """Every calendar day of ``month`` (``YYYY-MM``), leap days included."""
    start = F.to_date(F.lit(f"{month}-01"))
    one = spark.range(1).select(start.alias("start"))
    return one.select(F.explode(F.sequence("start", F.last_day("start"), F.expr("INTERVAL 1 DAY"))).alias("day"))


def missing_days(have: DataFrame, month: str, day_col: str = "day") -> DataFrame:
    """Days of ``month`` with no row in ``have``. ``have`` is reduced to its
    distinct days first (partial aggregation), so the anti join's right side
    is at most 31 rows whatever the data size."""
    days = have.select(F.col(day_col).alias("day")).distinct()
    return expected_days(have.sparkSession, month).join(F.broadcast(days.where(
        F.date_format("day", "yyyy-MM") == month)), "day", "left_anti")
