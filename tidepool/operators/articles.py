"""The article load path (P9, P10, P16, J2, W1, A2): scraped rows -> new
store rows with dense ids, plus rejects and a load report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.dates import date_reject, normalize_date
from tidepool.operators.keyed import assign_ids, new_by_key
from tidepool.operators.stats import load_report

STORE_COLUMNS = ["article_id", "title", "source", "content", "publishedAt", "url", "label"]


def load_articles(batch: DataFrame, existing: DataFrame, order=("source", "row"),
                  label: str = "unknown") -> tuple[DataFrame, DataFrame]:
    """Returns ``(new_rows, rejects)``. A publish date is normalised to
    ``YYYY-MM-DD`` text (empty -> NULL); a date in no known format sends the
    row to ``rejects`` with its raw text (D11), as does a missing URL. One row per URL not yet
    stored, the first by ``order`` (D2); ids continue from the stored
    count."""
    d = normalize_date("publishedAt", F.col("source"))
    bad = date_reject("publishedAt", F.col("source"))
    bad = bad | F.col("url").isNull()
    rejects = batch.where(bad)
    ok = batch.where(~bad).withColumn("publishedAt", F.date_format(d, "yyyy-MM-dd"))
    new = new_by_key(ok, existing.select("url"), ["url"], list(order))
    ided = assign_ids(new, existing.count(), list(order))
    return ided.withColumn("label", F.lit(label)).select(*STORE_COLUMNS), rejects


def report(existing: DataFrame, new_rows: DataFrame) -> DataFrame:
    return load_report(existing, new_rows, "source")
