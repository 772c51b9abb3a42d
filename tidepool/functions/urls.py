"""URL helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepool.functions._col import as_col

# scheme "://" netloc, netloc ends at the first / ? or #
SITE_PATTERN = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)"


def site_of(c) -> Column:
    """URL -> ``scheme://netloc/`` with the scheme lower-cased; NULL when the
    URL has no scheme (D10)."""
    u = as_col(c)
    scheme = F.regexp_extract(u, SITE_PATTERN, 1)
    netloc = F.regexp_extract(u, SITE_PATTERN, 2)
    return F.when(scheme != "", F.concat(F.lower(scheme), F.lit("://"), netloc, F.lit("/")))


def host_of(c) -> Column:
    """netloc of a URL (no scheme); NULL when there is none."""
    u = as_col(c)
    netloc = F.regexp_extract(u, SITE_PATTERN, 2)
    return F.when(netloc != "", netloc)


def absolute_url(link, page_url) -> Column:
    """Make a site-relative link (``/path``) absolute against its page."""
    l, p = as_col(link), as_col(page_url)
    base = F.regexp_replace(site_of(p), "/$", "")
    return F.when(l.startswith("/") & ~l.startswith("//"), F.concat(base, l)).otherwise(l)
