"""Publish-date trimming and normalisation (article load path).

The reference converts site-specific date text to ``YYYY-MM-DD`` trying a
fixed list of formats in order. Here that is one ``coalesce`` of built-in
``try_to_date`` calls, so the whole conversion stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepool.functions._col import as_col

# ---------------------------------------------------------------------------
# Sites whose date text is trimmed before parsing, and the
# formats tried in order (date only; month name; short month name; US).
SITE_AT_SUFFIX = "WND"            # keep the text before " at"
SITE_TWO_COMMA_PARTS = "WorldHealth"  # keep the first two comma parts
SITE_WEEKDAY_PREFIX = "ZeroHedge"   # keep the part after ", " and before " -"
DATE_FORMATS = ["yyyy-M-d", "MMMM d, yyyy", "MMM d, yyyy", "M/d/yyyy"]
# Tweet creation times: v1.1 "Wed Oct 10 20:19:24 +0000 2018" (parsed after
# the weekday, which Spark's parser does not accept) and v2 ISO-8601.
V1_TIME_FORMAT = "MMM dd HH:mm:ss Z yyyy"
# ISO date-time with a numeric offset or Z; the date is taken as written.
ISO_OFFSET = r"^(\d{4}-\d{1,2}-\d{1,2})T\d{1,2}:\d{1,2}:\d{1,2}(Z|[+-]\d{2}:?\d{2})$"
# ---------------------------------------------------------------------------


def trim_date(c, source) -> Column:
    """Cut the site-specific decoration off a date text."""
    s, src = as_col(c), as_col(source)
    return (F.when(src == SITE_AT_SUFFIX, F.substring_index(s, " at", 1))
            .when(src == SITE_TWO_COMMA_PARTS, F.substring_index(s, ",", 2))
            .when(src == SITE_WEEKDAY_PREFIX,
                  F.substring_index(F.split_part(s, F.lit(", "), F.lit(2)), " -", 1))
            .otherwise(s))


def parse_date(c) -> Column:
    """Text -> DateType trying the known formats in order; NULL if none fits."""
    s = as_col(c)
    iso = F.regexp_extract(s, ISO_OFFSET, 1)
    tries = [F.try_to_date(s, fmt) for fmt in DATE_FORMATS[:1]]
    tries.append(F.try_to_date(F.when(iso != "", iso), "yyyy-M-d"))
    tries += [F.try_to_date(s, fmt) for fmt in DATE_FORMATS[1:]]
    return F.coalesce(*tries)


def normalize_date(c, source=None) -> Column:
    """P9 + P10: the publish date as a DateType; empty text -> NULL."""
    s = as_col(c)
    trimmed = trim_date(s, source) if source is not None else s
    return F.when(F.coalesce(s, F.lit("")) == "", F.lit(None).cast("date")).otherwise(parse_date(trimmed))


def date_reject(c, source=None) -> Column:
    """True where a non-empty date text fits no known format."""
    s = as_col(c)
    return (F.coalesce(s, F.lit("")) != "") & normalize_date(s, source).isNull()


def tweet_time(c) -> Column:
    """``created_at`` of a v1.1 or v2 tweet as a TIMESTAMP instant (the
    written offset honoured); NULL when it is neither."""
    s = as_col(c)
    return F.coalesce(F.try_to_timestamp(F.substring(s, 5, 64), F.lit(V1_TIME_FORMAT)),
                      F.try_to_timestamp(s))


def ntz_as_utc(c) -> Column:
    """A TIMESTAMP_NTZ wall-clock value read as UTC, as a TIMESTAMP instant
    (event-time watermarks need instants); independent of the session time
    zone."""
    return F.to_timestamp(F.concat(F.date_format(as_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))


def utc_day(c) -> Column:
    """``yyyy-MM-dd`` UTC day of a TIMESTAMP instant, by epoch arithmetic
    (no session time zone involved)."""
    days = F.floor(F.unix_seconds(as_col(c)) / 86400).cast("int")
    return F.date_format(F.date_add(F.to_date(F.lit("1970-01-01")), days), "yyyy-MM-dd")
