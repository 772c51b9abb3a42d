"""Frequency rankings and summary counts.

Every ranking explodes to one row per item, aggregates with a map-side
partial count before the shuffle (so a hot item costs one row per map
task, not one per occurrence) and takes the top N with ``orderBy().limit()``,
which Spark runs as a per-partition top-N plus one bounded merge.
Ties break by the item ascending.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.text import split_entities, tokens
from tidepool.functions.urls import site_of


def top_n(df: DataFrame, order_col: str, key_col: str, n: int) -> DataFrame:
    """Descending by ``order_col``, ties by ``key_col`` ascending, first n."""
    return df.orderBy(F.desc(order_col), F.asc(key_col)).limit(n)


def count_items(items: DataFrame, item_col: str = "term", out: str = "n") -> DataFrame:
    return items.groupBy(item_col).agg(F.count(F.lit(1)).alias(out))


def top_items(df: DataFrame, array_col, n: int = 20, item: str = "term") -> DataFrame:
    exploded = df.select(F.explode(array_col).alias(item))
    return top_n(count_items(exploded, item), "n", item, n)


def top_words(df: DataFrame, text_col: str = "text", n: int = 20, stopwords=None) -> DataFrame:
    """A3: most frequent tokens of cleaned text, stopwords removed."""
    return top_items(df, tokens(text_col, stopwords), n)


def top_tags(df: DataFrame, col: str = "hashtags_str", n: int = 20) -> DataFrame:
    """A4: most frequent hashtags (case-blind)."""
    return top_items(df, split_entities(col), n)


def top_mentions(df: DataFrame, col: str = "mentions_str", n: int = 20) -> DataFrame:
    """A5: most frequent mentions (case-blind)."""
    return top_items(df, split_entities(col), n)


def top_sites(df: DataFrame, col: str = "expanded_urls", n: int = 20) -> DataFrame:
    """A10: most frequent ``scheme://host/`` of the linked URLs."""
    sites = F.filter(F.transform(split_entities(col, lower=False), lambda u: site_of(u)),
                     lambda s: s.isNotNull())
    return top_items(df, sites, n, item="site")


def distinct_links(df: DataFrame, col: str = "link") -> DataFrame:
    """Distinct links over several listings."""
    return df.select(col).dropDuplicates([col])


def summary(parts: dict[str, DataFrame]) -> DataFrame:
    """Named counts as ``(metric, value)`` rows; one small aggregate each,
    stacked with a union (no cross join of single-row frames)."""
    rows = [df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value")
            for name, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)


def load_report(before: DataFrame, inserted: DataFrame, source_col: str = "source") -> DataFrame:
    """A2: rows inserted per source, with ``before``/``inserted``/``after``
    totals as extra rows (source names them). Each side is scanned once:
    rows are counted per side and source, and the few counts are then summed
    into the rows they belong to. A NULL source is a source of its own; totals
    of empty sides are 0."""
    sides = before.select(F.lit(False).alias("_new"), F.lit(None).cast("string").alias("_src")).unionByName(
        inserted.select(F.lit(True).alias("_new"), F.col(source_col).cast("string").alias("_src")))
    counts = sides.groupBy("_new", "_src").agg(F.count(F.lit(1)).alias("n"))

    def row(total: bool, name: Column) -> Column:
        return F.struct(F.lit(total).alias("total"), name.alias("name"))

    into = F.when(F.col("_new"), F.array(row(False, F.col("_src")), row(True, F.lit("<inserted>")), row(True, F.lit("<after>")))) \
        .otherwise(F.array(row(True, F.lit("<before>")), row(True, F.lit("<after>"))))
    none = before.sparkSession.sql("SELECT struct(true AS total, name) AS r, 0L AS n FROM VALUES ('<before>'), ('<inserted>'), ('<after>') AS t(name)")
    return (counts.select(F.explode(into).alias("r"), "n").unionByName(none)
            .groupBy("r").agg(F.sum("n").alias("n")).select(F.col("r.name").alias(source_col), "n"))
