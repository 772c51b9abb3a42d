"""The listing walk against a plain walk, page by page."""

import random

from tidepool.operators.listing_walk import walk_links, walk_pages


def plain(pages, starts):
    nxt = {}
    for u, n in pages:
        if u is not None:
            nxt[u] = min((x for x in (nxt.get(u), n) if x is not None), default=None)
    out = set()
    for s in {x for x in starts if x in nxt}:
        met, at = [], s
        while at in nxt and at not in met:
            met.append(at)
            at = nxt[at]
        out |= {(s, i, u) for i, u in enumerate(met)}
    return out


def run(spark, pages, starts, **kw):
    p = spark.createDataFrame(pages, "url string, next_url string")
    s = spark.createDataFrame([(x,) for x in starts], "url string")
    rows = [tuple(r) for r in walk_pages(p, s, **kw).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_ends_cycles_and_odd_rows(spark):
    pages = [("a", "b"), ("b", "c"), ("c", None), ("d", "e"), ("e", "f"), ("f", "d"), ("g", "g"), ("h", "d"), ("i", "gone"),
             (None, "a"), (None, None), ("j", "k"), ("j", "i"), ("j", None), ("k", ""), ("", "a")]
    starts = ["a", "a", "b", "d", "e", "g", "h", "i", "j", "k", "gone", None, ""]
    assert run(spark, pages, starts) == plain(pages, starts)


def test_random_pages_with_a_hot_page(spark):
    rng = random.Random(7)
    names = [f"p{i}" for i in range(400)]
    pages = [(u, "p0" if rng.random() < 0.35 else rng.choice(names)) for u in names]
    starts = rng.sample(names, 150)
    want = plain(pages, starts)
    assert run(spark, pages, starts) == want
    assert run(spark, pages, starts, hot_rows=20) == want  # hot keys are split off


def test_empty_tables(spark):
    assert run(spark, [], ["a"]) == set() and run(spark, [("a", "b")], []) == set()


def test_ten_thousand_pages_take_few_rounds(spark, monkeypatch):
    from tidepool.operators import listing_walk as lw
    cuts, cut = [], lw.cut_lineage
    monkeypatch.setattr(lw, "cut_lineage", lambda df: cuts.append(1) or cut(df))
    n = 10_000
    pages = spark.range(n).selectExpr("concat('u', id) AS url", f"if(id = {n - 1}, NULL, concat('u', id + 1)) AS next_url")
    start = spark.createDataFrame([("u0",)], "url string")
    got = walk_pages(pages, start).selectExpr("count(*) AS n", "max(pos) AS last", "count_if(url = concat('u', pos)) AS right").first()
    assert tuple(got) == (n, n - 1, n)
    assert len(cuts) <= 3 + 4 * 14


def test_links_are_kept_where_first_met(spark):
    walk = spark.createDataFrame([("s", 0, "a"), ("s", 1, "b"), ("t", 0, "b")], "start string, pos long, url string")
    links = spark.createDataFrame([("a", 0, "x"), ("a", 1, "y"), ("a", 2, "x"), ("b", 0, "y"), ("b", 1, "z"), ("b", 2, None), ("c", 0, "q")],
                                  "url string, link_pos int, link string")
    got = {tuple(r) for r in walk_links(walk, links).collect()}
    assert got == {("s", "x", 0, 0), ("s", "y", 0, 1), ("s", "z", 1, 1), ("t", "y", 0, 0), ("t", "z", 0, 1)}
    hot = spark.range(500).selectExpr("'s' AS start", "id AS pos", "concat('p', id) AS url")
    same = spark.range(500).selectExpr("concat('p', id) AS url", "0 AS link_pos", "'home' AS link")
    assert [tuple(r) for r in walk_links(hot, same).collect()] == [("s", "home", 0, 0)]
