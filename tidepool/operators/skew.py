"""Joins against a unique-key lookup table that survive a hot probe key.

A reshare forest is the textbook skew case: one viral post can own a third
of all rows, so a plain shuffle join sends all of them to one task. The
probe side is split: keys holding at least ``hot_rows`` rows (at most
``max_hot`` of them, found with a partially aggregated count) join a
broadcast of just their lookup rows - at most ``max_hot`` rows because the
lookup keys are unique - and every other key takes the ordinary shuffle
join. Nothing is dropped or sampled; the two halves are disjoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_HOT_ROWS = 100_000
DEFAULT_MAX_HOT = 1_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = DEFAULT_HOT_ROWS,
             max_hot: int = DEFAULT_MAX_HOT) -> DataFrame:
    """The heaviest keys of ``df`` with at least ``hot_rows`` rows; never
    more than ``max_hot`` rows, so it is safe to broadcast."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return (counts.where(F.col("_n") >= hot_rows)
            .orderBy(F.desc("_n")).limit(max_hot).select(F.col(key).alias("_hot")))


def lookup_join(probe: DataFrame, probe_key: str, lookup: DataFrame, lookup_key: str,
                how: str = "inner", hot_rows: int = DEFAULT_HOT_ROWS,
                max_hot: int = DEFAULT_MAX_HOT, probe_rows: int | None = None,
                hot: DataFrame | None = None) -> DataFrame:
    """``probe JOIN lookup ON probe_key = lookup_key`` where ``lookup_key``
    is unique in ``lookup``. ``how`` is inner, left, left_semi or left_anti.
    ``probe`` is read up to three times: pass a materialised or cheap frame.
    When the caller knows the probe has fewer than ``hot_rows`` rows
    (``probe_rows``), no key can be hot and the plain join is used. A caller
    that already counted the probe keys passes the hot set (column
    ``_hot``, at most ``max_hot`` rows) as ``hot``.

    Output columns: those of ``probe`` (plus those of ``lookup`` for inner
    and left joins)."""
    if probe_rows is not None and probe_rows < hot_rows:
        return probe.join(lookup, probe[probe_key] == lookup[lookup_key], how)
    hot = F.broadcast(hot if hot is not None else hot_keys(probe, probe_key, hot_rows, max_hot))
    is_hot = probe[probe_key] == hot["_hot"]
    probe_hot = probe.join(hot, is_hot, "left_semi")
    probe_cold = probe.join(hot, is_hot, "left_anti")
    lookup_hot = lookup.join(hot, lookup[lookup_key] == hot["_hot"], "left_semi")

    def _join(p, l, small):
        l2 = F.broadcast(l) if small else l
        return p.join(l2, p[probe_key] == l2[lookup_key], how)

    return _join(probe_hot, lookup_hot, True).unionByName(_join(probe_cold, lookup, False))
