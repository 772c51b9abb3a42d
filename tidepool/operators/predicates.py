"""Filters and search rules.

Predicates are plain Column expressions, so Catalyst pushes the simple ones
(language, time range) into the Parquet scan and fuses the rest into the
same codegen stage.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.text import split_entities


def select_where(df: DataFrame, cols: list[str], cond=None) -> DataFrame:
    """Chosen columns with an optional condition (SQL text or Column);
    Catalyst prunes the scan to ``cols`` and pushes the condition."""
    return (df.where(cond if not isinstance(cond, str) else F.expr(cond)) if cond is not None else df).select(*cols)


def recent_window(df: DataFrame, ts_col: str, now, days: int = 7, margin_minutes: int = 1) -> DataFrame:
    """T3 (batch): rows in ``[now - days, now - margin)``, the daily
    re-collection window; a stream gets the same bound from a
    ``days``-day watermark."""
    now_c = F.lit(now).cast("timestamp_ntz") if isinstance(now, str) else F.lit(now)
    lo = now_c - F.expr(f"INTERVAL {int(days)} DAYS")
    hi = now_c - F.expr(f"INTERVAL {int(margin_minutes)} MINUTES")
    return df.where((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))


def union_distinct(dfs: list[DataFrame]) -> DataFrame:
    """Union of several hit lists by column name, duplicates removed."""
    return reduce(DataFrame.unionByName, dfs).distinct()


def lang_is(df: DataFrame, lang: str, col: str = "lang") -> DataFrame:
    """F1."""
    return df.where(F.col(col) == F.lit(lang))


def tags_present(tags: list[str], tags_col="hashtags_str") -> Column:
    """All of ``tags`` are among the row's hashtags (case-blind)."""
    want = F.array(*[F.lit(t.lower()) for t in tags])
    return F.size(F.array_except(want, split_entities(tags_col))) == 0


def has_all_tags(df: DataFrame, tags: list[str], tags_col="hashtags_str") -> DataFrame:
    """F2."""
    return df.where(tags_present(tags, tags_col))


def links_present(urls_col="expanded_urls") -> Column:
    return F.size(split_entities(urls_col, lower=False)) > 0


def has_links(df: DataFrame, urls_col="expanded_urls") -> DataFrame:
    """F3."""
    return df.where(links_present(urls_col))


def not_retweet(df: DataFrame, kind_col="kind") -> DataFrame:
    """F4."""
    return df.where(F.col(kind_col) != "retweet")


def only_retweets(df: DataFrame, kind_col="kind") -> DataFrame:
    """F6."""
    return df.where(F.col(kind_col) == "retweet")


def non_replies(df: DataFrame, kind_col="kind") -> DataFrame:
    """F7."""
    return df.where(F.col(kind_col) != "reply")


def time_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """F8: ``start <= col < end`` (literal bounds reach the Parquet scan)."""
    return df.where((F.col(col) >= F.lit(start)) & (F.col(col) < F.lit(end)))


def time_range_utc(df: DataFrame, col: str, start: str, end: str) -> DataFrame:
    """F8 for TIMESTAMP instants: ``start <= col < end`` with bounds written
    as UTC ``YYYY-MM-DD HH:MM:SS``, compared as epoch microseconds so the
    result does not depend on the session time zone."""
    import datetime as dt

    def micros(t):
        return int(dt.datetime.fromisoformat(t).replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    us = F.unix_micros(F.col(col))
    return df.where((us >= F.lit(micros(start))) & (us < F.lit(micros(end))))


def any_term(df: DataFrame, col: str, terms: list[str]) -> DataFrame:
    """any of the terms occurs, case-blind."""
    pattern = "(?i)" + "|".join(re.escape(t) for t in terms)
    return df.where(F.col(col).rlike(pattern))


def rule_predicate(rule: str, *, tags_col="hashtags_str", urls_col="expanded_urls",
                   kind_col="kind", lang_col="lang") -> Column:
    """One search rule: blank-separated terms, all must hold. Terms are
    ``#tag``, ``has:links``, ``-is:retweet``, ``is:retweet``, ``lang:xx``."""
    conds = []
    tags = []
    for term in rule.split():
        if term.startswith("#"):
            tags.append(term)
        elif term == "has:links":
            conds.append(links_present(urls_col))
        elif term == "-is:retweet":
            conds.append(F.col(kind_col) != "retweet")
        elif term == "is:retweet":
            conds.append(F.col(kind_col) == "retweet")
        elif term.startswith("lang:"):
            conds.append(F.col(lang_col) == term[len("lang:"):])
        else:
            raise ValueError(f"unsupported rule term: {term}")
    if tags:
        conds.insert(0, tags_present(tags, tags_col))
    return reduce(lambda a, b: a & b, conds)


def match_rules(df: DataFrame, rules: list[str], **cols) -> DataFrame:
    """rows matching any rule (rules OR-ed, terms AND-ed)."""
    return df.where(reduce(lambda a, b: a | b, [rule_predicate(r, **cols) for r in rules]))


def take_while_sorted(df: DataFrame, part: str, order: str, date: str,
                      num_partitions: int | None = None) -> DataFrame:
    """per ``part`` (NULL is a part of its own), rows in ``order`` up to
    (not including) the first row whose ``date`` is later than the row before
    it. Rows of equal order go by date, NULL first; a NULL date is never later
    and no date is later than it. Rows without ``order`` are kept and are no
    part of the scan.

    No window per part, so a part of any size spreads over many tasks: the
    ``(part, order, date)`` keys are range-partitioned into slices and written;
    a window over each slice flags rises inside it; the first row of a slice
    is compared with the last row of the slice before (one summary row a
    slice); the first rise per part is a partially aggregated ``min``, and rows
    before it are kept through a hot-key-safe lookup join."""
    from tidepool.operators.chains import cut_lineage
    from tidepool.operators.skew import lookup_join

    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(F.col(part).alias("p"), F.col(order).alias("o"), F.col(date).alias("d")).where("o IS NOT NULL")
    slices = cut_lineage(keys.repartitionByRange(n, "p", "o").withColumn("slice", F.spark_partition_id()))
    at = Window.partitionBy("slice").orderBy("p", "o", "d")
    before = slices.withColumn("_b", F.lag(F.struct("p", "d")).over(at))
    later = F.col("_b").isNotNull() & F.col("_b.p").eqNullSafe(F.col("p")) & (F.col("d") > F.col("_b.d"))
    inside = before.where(later).groupBy("p").agg(F.min(F.struct("o", "d")).alias("f"))
    # one row a slice: its first row beside the last row of the slice before
    ends = slices.groupBy("slice").agg(F.min(F.struct("p", "o", "d")).alias("head"), F.max(F.struct("p", "o", "d")).alias("last"))
    ends = ends.withColumn("_b", F.lag("last").over(Window.orderBy("slice"))).select("head.*", "_b")
    first = inside.unionByName(ends.where(later).select("p", F.struct("o", "d").alias("f"))).groupBy("p").agg(F.min("f").alias("_first"))
    # the NULL part matches no join key: its one row travels as a broadcast
    none = F.broadcast(first.where("p IS NULL").select(F.col("_first").alias("_null_first")))
    j = lookup_join(df, part, first.where("p IS NOT NULL").withColumnRenamed("p", "_fp"), "_fp", how="left") \
        .join(none, F.col(part).isNull(), "left")
    stop = F.coalesce("_first", "_null_first")
    here = F.struct(F.col(order).alias("o"), F.col(date).alias("d"))
    return j.where(stop.isNull() | F.col(order).isNull() | (here < stop)).drop("_fp", "_first", "_null_first")
