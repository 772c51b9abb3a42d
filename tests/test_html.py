from pyspark.sql import functions as F

from tidepool.functions.html import paragraphs
from tidepool.operators.html_extract import extract_articles, extract_one, listing_cards, next_link, rules_frame

BLP = """<html><body><div class="mvp-main-blog-body left relative"><li class="mvp-blog-story-wrap left relative infinite-post"><a href="/a1">x</a></li></div>
<div class="pagination"><a href="/p1">Prev</a><a href="/p3">Next &rsaquo;</a><a href="/last">Last</a></div>
<div id="mvp-post-main"><h1 class="mvp-post-title left entry-title">Title &amp; more</h1>
<span class="mvp-post-date updated"><time datetime="2020-03-25T20:07:28+00:00">Mar</time></span>
<div id="mvp-content-main"><p>one</p><div><p>nested</p></div><p>two <b>bold</b></p></div></div></body></html>"""

GGI = """<header class="td-post-title"><h1>T</h1><time datetime="2020-01-02">x</time></header>
<div class="td-post-content"><ul><li><p>item</p></li></ul><p>open para<p>next</p><h2>sub</h2></div>"""


def rule(site):
    from tidepool.operators.html_extract import SITE_RULES, DEFAULT_BODY_TAGS
    r = dict(next(x for x in SITE_RULES if x["site"] == site))
    r.setdefault("body_tags", DEFAULT_BODY_TAGS)
    return r


def test_direct_children_only_and_date_attr():
    title, content, date, nxt, items, _ = extract_one(BLP, rule("BigLeaguePolitics"))
    assert title == "Title & more"
    assert content == "one\ntwo bold"
    assert date == "2020-03-25T20:07:28+00:00"
    assert nxt == "/p3" and items == ["/a1"]


def test_nested_tags_repeat_and_unclosed_p():
    title, content, date, _, _, _ = extract_one(GGI, rule("GreatGameIndia"))
    assert title == "T" and date == "2020-01-02"
    # li and its p both count (nested text repeats); an open <p> ends at the next block
    assert content.split("\n") == ["item", "item", "open para", "next", "sub"]


def test_extract_articles_joins_rules(spark):
    pages = spark.createDataFrame([(1, "https://x.org/a", "BigLeaguePolitics", BLP),
                                   (2, "https://y.org/b", "nosuchsite", BLP)],
                                  "page_id long, url string, site string, html string")
    got = extract_articles(pages, rules_frame(spark)).collect()
    assert [(r.page_id, r.title) for r in got] == [(1, "Title & more")]


def test_tier_a_paragraphs_and_next_link(spark):
    html = '<nav><a href="/x">x</a><a href="/y">y</a></nav><article><p><b>a</b><br><p>b &amp; c</p><p> </p></article>'
    df = spark.createDataFrame([(1, "HTTPS://h.com/p?q", html)], "page_id long, url string, html string")
    art = F.regexp_extract("html", r"(?s)<article>(.*?)</article>", 1)
    assert df.select(paragraphs(art)).first()[0] == ["a", "b & c"]
    assert next_link(df, "nav").first().next_url == "https://h.com/y"


def test_listing_cards_last_wins(spark):
    cards = spark.createDataFrame([("u", 1, "old"), ("u", 3, "new"), ("u", 2, "mid"), ("v", 1, "v1")],
                                  "url string, seq int, title string")
    got = sorted(tuple(r) for r in listing_cards(cards, "url", "seq", ["title"]).collect())
    assert got == [("u", "new"), ("v", "v1")]


def test_next_link_by_child_icon():
    html = ('<div class="page-nav td-pb-padding-side"><a href="/1"><i class="td-icon-menu-left"></i></a>'
            '<a href="/3"><i class="td-icon-menu-right"></i></a><a href="/9">9</a></div>')
    assert extract_one(html, rule("DCClothesline"))[3] == "/3"


def test_date_after_marker_and_nth_span():
    wnd = ('<div class="entry-meta"><span>By A</span><span>Published March 25, 2020 at 1:40pm</span></div>'
           '<header class="entry-header"><h1 class="entry-title">T</h1></header>')
    assert extract_one(wnd, rule("WND"))[2] == "March 25, 2020 at 1:40pm"
    hin = '<h2 class="entry-title">T</h2><div class="entry-date">Posted on March 18, 2020 on site</div>'
    assert extract_one(hin, rule("HealthImpactNews"))[2] == "March 18, 2020"
    assert extract_one('<div class="entry-date">no marker</div>', rule("HealthImpactNews"))[2] is None


def test_next_link_by_rules(spark):
    pages = spark.createDataFrame([(1, "https://x.org/list", "BigLeaguePolitics", BLP)],
                                  "page_id long, url string, site string, html string")
    assert next_link(pages, rules=rules_frame(spark)).first().next_url == "https://x.org/p3"


def test_cards_first_next_and_deep_pages(spark):
    from tidepool.operators.html_extract import cut_cards
    card = ('<div class="td-block-span6"><h3 class="entry-title td-module-title"><a href="/c{0}">T{0}</a></h3>'
            '<div class="td-post-date"><time datetime="2020-01-0{0}">x</time></div></div>')
    page = '<div class="td-ss-main-content">' + "".join(card.format(i) for i in (1, 2, 3)) + "</div>"
    pages = spark.createDataFrame([(1, "https://i.org/list", "Intellihub", page)], "page_id long, url string, site string, html string")
    got = [tuple(r) for r in cut_cards(pages, rules=rules_frame(spark)).orderBy("pos").select("link", "title", "date").collect()]
    assert got == [(f"https://i.org/c{i}", f"T{i}", f"2020-01-0{i}") for i in (1, 2, 3)]
    two = '<nav class="pager"><li class="pager__item pager__item--next"><a href="/n1">a</a><a href="/n2">b</a></li></nav>'
    assert extract_one(two, rule("ZeroHedge"))[3] == "/n1"
    deep = "<h1>T</h1><article><p>one</p>" + "<li>" * 5000 + "end"
    assert extract_one(deep, rule("generic"))[:2] == ("T", "one")


def test_character_references(spark):
    from pyspark.sql import functions as F
    from tidepool.functions.html import decode_entities
    cases = {"a &#8217; b&rsquo;c": "a \u2019 b\u2019c", "caf&eacute; &#xE9;&#233": "caf\u00e9 \u00e9\u00e9", "&amp;lt; &amp": "&lt; &",
             "&unknown; & &": "&unknown; & &", "&#0;&#x110000;": "\ufffd\ufffd", "&#128512;&Omega;&hellip;": "\U0001f600\u03a9\u2026", "": "", "plain": "plain",
             "&copy 1 &nbsp;x&#99999999999999999999;": "\u00a9 1 \u00a0x\ufffd", "&": "&", "x&;": "x&;"}
    got = {r.c: r.d for r in spark.createDataFrame([(c,) for c in cases], "c string").select("c", decode_entities(F.col("c")).alias("d")).collect()}
    assert got == cases
