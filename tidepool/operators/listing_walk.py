"""The listing walk (P13, P14, A12): from a start page along its "next" links
to the end, and the links of the pages met, in order.

List ranking by pointer doubling. A round joins what has been walked so far,
the first 2^k pages of every walk that is still open, with a table of jumps 2^k
pages ahead, and doubles the jumps by joining them with themselves: a chain of
10,000 pages takes 14 rounds of two joins, not 10,000. Each round is cut with a
reliable checkpoint. Walks that have ended leave the rounds.

A walk ends before the first page that it has already met (cycles end), at a
page without a next link, and at a next link to a page that is not there. Many
pages may name one page as their next one and many walks may share a page:
joins go through ``lookup_join``, which splits hot keys off.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators.chains import cut_lineage
from tidepool.operators.skew import DEFAULT_HOT_ROWS, lookup_join


def walk_pages(pages: DataFrame, starts: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """``(start, pos, url)``: the pages of every walk, from position 0.

    ``pages`` has ``url`` and ``next_url``, ``starts`` has ``url``. Of several
    rows of one url the smallest next link counts (one that is NULL last);
    NULL urls are no pages; starts count once, starts without a page give no
    rows."""
    known = cut_lineage(pages.where("url IS NOT NULL").groupBy("url").agg(F.min("next_url").alias("next_url")))
    n_known = known.count()
    urls = known.select(F.col("url").alias("_u"))
    jumps = cut_lineage(lookup_join(known.where("next_url IS NOT NULL"), "next_url", urls, "_u", how="left_semi",
                                    hot_rows=hot_rows, probe_rows=n_known)
                        .select(F.col("url").alias("node"), F.col("next_url").alias("to")))
    open_rows = cut_lineage(starts.select(F.col("url").alias("start")).distinct()
                            .join(urls, F.col("start") == F.col("_u"), "left_semi")
                            .select("start", F.lit(0).cast("long").alias("pos"), F.col("start").alias("node")))
    ended, ahead = [], 1  # open walks have ``ahead`` pages so far
    n_open = open_rows.count()
    while n_open:
        side = jumps.select(F.col("node").alias("_n"), "to")
        further = lookup_join(open_rows, "node", side, "_n", hot_rows=hot_rows, probe_rows=n_open).select(
            "start", (F.col("pos") + ahead).alias("pos"), F.col("to").alias("node"))
        # positions after the first page met twice only hold pages met before
        both = cut_lineage(open_rows.unionByName(further).groupBy("start", "node").agg(F.min("pos").alias("pos"))
                           .select("start", "pos", "node"))
        ahead *= 2
        # a walk is still open if its last position of this round holds a page
        more = both.where(F.col("pos") == ahead - 1).select(F.col("start").alias("_s"))
        n_both = both.count()
        ended.append(cut_lineage(lookup_join(both, "start", more, "_s", how="left_anti", hot_rows=hot_rows, probe_rows=n_both)))
        open_rows = cut_lineage(lookup_join(both, "start", more, "_s", how="left_semi", hot_rows=hot_rows, probe_rows=n_both))
        n_open = open_rows.count()
        if n_open:
            side = jumps.select(F.col("node").alias("_n"), F.col("to").alias("_t"))
            jumps = cut_lineage(lookup_join(jumps, "to", side, "_n", hot_rows=hot_rows, probe_rows=n_known).select("node", F.col("_t").alias("to")))
    out = reduce(DataFrame.unionByName, ended) if ended else open_rows
    return out.select("start", "pos", F.col("node").alias("url"))


def walk_links(walk: DataFrame, links: DataFrame) -> DataFrame:
    """``(start, link, pos, link_pos)``: the distinct links of each walk with
    the place where each is met first: the page's position and the link's
    position in the page. ``links`` has ``(url, link_pos, link)``; NULL links
    are none. Rows are combined before the shuffle, so a link on every page of
    a walk is one row a task."""
    held = links.where("link IS NOT NULL").groupBy("url", "link").agg(F.min("link_pos").alias("link_pos"))
    met = walk.join(held, "url")
    first = met.groupBy("start", "link").agg(F.min(F.struct("pos", "link_pos")).alias("f"))
    return first.select("start", "link", "f.pos", "f.link_pos")
