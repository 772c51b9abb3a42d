"""Landed-file sources and sinks: article CSVs, ID lists, daily TSVs,
pages (S1-S3, S6, S10, S12, U1).

Where a value lives in the file name (site, month, ``_clean`` variant) it
is read from the ``_metadata`` column, which every file source carries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.schemas import ARTICLE_CSV

# CSV dialect of the article files: header, quoted fields holding newlines,
# quotes escaped by doubling; values are written and read untrimmed.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _last_dir(path_col):
    """Name of the folder holding a file; ``key=value`` folders give value."""
    d = F.regexp_extract(path_col, r"([^/]+)/[^/]+$", 1)
    return F.regexp_replace(d, r"^[^=]*=", "")


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Per-site article CSVs; ``source`` is the file name without
    ``.csv`` (or the ``source=`` folder when written by ``write_articles``).
    Multi-line CSV cannot be split inside a file: one task per file."""
    df = spark.read.options(**CSV_OPTIONS).schema(ARTICLE_CSV).csv(path)
    if "source" not in df.columns:
        name = F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", "")
        df = df.withColumn("source", name)
    return df


def write_articles(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Article rows, partitioned by site. Parquet by default; CSV
    in the reference's dialect for interchange. ``mode='overwrite'``
    replaces instead of appending."""
    w = df.write.mode(mode).partitionBy("source")
    if fmt == "csv":
        w.options(**CSV_OPTIONS).csv(path)
    else:
        w.parquet(path)


def read_id_files(spark: SparkSession, path: str) -> DataFrame:
    """Text files with one tweet ID per line under month folders;
    ``(month, tweet_id)``, IDs trimmed, blank lines dropped."""
    t = spark.read.option("recursiveFileLookup", "true").text(path)
    return (t.select(_last_dir(F.col("_metadata.file_path")).alias("month"),
                     F.trim("value").alias("tweet_id"))
            .where(F.col("tweet_id") != ""))


def write_id_files(ids: DataFrame, path: str, month_col: str = "month", mode: str = "append") -> None:
    """ID lists as text, one folder per month."""
    ids.select(month_col, "tweet_id").write.mode(mode).partitionBy(month_col).text(path)


def month_ids(spark: SparkSession, path: str, month: str) -> DataFrame:
    """Every ID file of one month as one frame (a multi-file read; only
    that month's folder is listed)."""
    root = path.rstrip("/")
    t = spark.read.text(f"{root}/*{month}/")
    return t.select(F.trim("value").alias("tweet_id")).where(F.col("tweet_id") != "")


def read_daily_tsv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """S3: daily TSVs with a header (at least ``tweet_id``, ``lang``); the
    ``clean`` variant has ``_clean`` in its name or folder. A file's header is
    its first line that is not empty, and each file is read by its own, whatever
    the order of its columns; a column that a file lacks is NULL there, and so
    is an empty cell. A data row that looks like a header of another file is a
    data row. With ``columns`` given the frame is defined without running
    a job; without it one job looks for the names that the headers hold. ``.gz``
    files are read directly (one task per file)."""
    lines = (spark.read.option("recursiveFileLookup", "true").text(path)
             .select("value", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_start")).where("value <> ''"))
    # the first line of a file's first split: ids rise along the lines of a split
    heads = (lines.where("_start = 0").withColumn("_at", F.monotonically_increasing_id())
             .groupBy("_file").agg(F.min_by("value", "_at").alias("_head")))  # one row a file
    if columns is None:
        kinds = [r["_head"] for r in heads.select("_head").distinct().collect()]  # one row a variant of the header
        columns = list(dict.fromkeys(c for h in sorted(kinds) for c in h.split("\t")))
    cells, names = F.split("value", "\t", -1), F.split("_head", "\t", -1)
    at = [F.array_position(names, c).alias(f"_at_{i}") for i, c in enumerate(columns)]
    rows = lines.join(heads.select("_file", "_head", *at), "_file").where("value <> _head").withColumn("_cells", cells)
    value = [F.when(F.col(f"_at_{i}") > 0, F.nullif(F.get("_cells", (F.col(f"_at_{i}") - 1).cast("int")), F.lit(""))).alias(c)
             for i, c in enumerate(columns)]
    variant = F.when(F.col("_file").contains("_clean"), "clean").otherwise("full")
    return rows.select(*value, variant.alias("variant"))


def write_daily_tsv(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).option("sep", "\t").option("header", "true").csv(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Raw pages ``(page_id, url, html)``."""
    return spark.read.parquet(path).select("page_id", "url", "html")
