"""Article extraction from raw pages.

Tier (a): flat rules as built-in regex expressions (see
``tidepool.functions.html``), used by the checks with a SQL twin.
Tier (b): per-site rules with nested containers, walked by the standard
library's HTML parser inside ``mapInPandas``. Only ``(page_id, url, html)``
and the site's rule (a broadcast table of one row per site) reach Python,
in Arrow batches; the walker is a small helper, not a library.
"""

from __future__ import annotations

import json
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, LongType, StringType,
                               StructField, StructType)

from tidepool.functions.html import hrefs, inner_html
from tidepool.functions.urls import absolute_url

STEP = StructType([StructField("tag", StringType()), StructField("id", StringType()),
                   StructField("cls", StringType())])
PATH = ArrayType(STEP)
RULE = StructType([
    StructField("site", StringType()), StructField("item_scope", PATH), StructField("item_path", PATH),
    StructField("card_title", PATH), StructField("card_date", PATH), StructField("card_date_attr", StringType()),
    StructField("next_first", BooleanType()), StructField("date_after_tag", StringType()),
    StructField("link_root", BooleanType()), StructField("next_path", PATH),
    StructField("next_text", StringType()), StructField("next_child", PATH),
    StructField("title_path", PATH), StructField("body_path", PATH),
    StructField("body_tags", ArrayType(StringType())), StructField("direct_only", BooleanType()),
    StructField("date_path", PATH), StructField("date_attr", StringType()),
    StructField("date_after", StringType()), StructField("date_nth", IntegerType()),
])


def _p(*steps):
    """Path literal: 'tag', 'tag#id', 'tag.class words' (descendant steps)."""
    out = []
    for s in steps:
        tag, _, rest = s.partition(".")
        tag, _, ident = tag.partition("#")
        out.append({"tag": tag or None, "id": ident or None, "cls": rest or None})
    return out


# ---------------------------------------------------------------------------
# Per-site extraction rules (listing item, next page, title,
# body, date), and the rule for generic article pages.
SITE_RULES = [
    dict(site="BigLeaguePolitics", item_scope=_p("div.mvp-main-blog-body left relative"),
         item_path=_p("li.mvp-blog-story-wrap left relative infinite-post", "a"),
         next_path=_p("div.pagination", "a"), next_text="Next \u203a",
         title_path=_p("div#mvp-post-main", "h1.mvp-post-title left entry-title"),
         body_path=_p("div#mvp-content-main"), body_tags=["p"], direct_only=True,
         date_path=_p("span.mvp-post-date updated", "time"), date_attr="datetime"),
    dict(site="DCClothesline", item_path=_p("div.td-block-span6", "h3.entry-title td-module-title", "a"),
         next_path=_p("div.page-nav td-pb-padding-side", "a"), next_child=_p("i.td-icon-menu-right"),
         title_path=_p("header.td-post-title", "h1.entry-title"),
         body_path=_p("div.td-post-content tagdiv-type"), body_tags=["p"], direct_only=True,
         date_path=_p("span.td-post-date", "time"), date_attr="datetime"),
    dict(site="GreatGameIndia", item_path=_p("div.td_module_10", "a.td-image-wrap"),
         next_path=_p("div.page-nav td-pb-padding-side", "a"), next_child=_p("i.td-icon-menu-right"),
         title_path=_p("header.td-post-title", "h1"),
         body_path=_p("div.td-post-content"), date_path=_p("header.td-post-title", "time"), date_attr="datetime"),
    dict(site="HealthImpactNews", item_scope=_p("div.acs_search_results_items"), item_path=_p("div.entry-permalink", "a"),
         title_path=_p("h2.entry-title"), body_path=_p("div.post-content"),
         date_path=_p("div.entry-date"), date_after="on "),
    dict(site="HealthNutNews", item_path=_p("article", "div.header", "a"),
         next_first=True, next_path=_p("div.archive-pagination", "li.next", "a"), title_path=_p("div.post-header", "h1.entry-title"),
         body_path=_p("div.post-content entry-content"), date_path=_p("span.updated")),
    dict(site="HumansAreFree", item_path=_p("div.post_grid_content_wrapper", "div.image-post-thumb", "a"),
         next_first=True, next_path=_p("nav.jellywp_pagination", "a.next page-numbers"), title_path=_p("h1.single_post_title_main"),
         body_path=_p("div.post_content"), date_path=_p("span.post-date updated"), date_attr="datetime"),
    dict(site="Intellihub", item_scope=_p("div.td-ss-main-content"),
         item_path=_p("div.td-block-span6", "h3.entry-title td-module-title", "a"),
         card_title=_p("h3.entry-title td-module-title", "a"), card_date=_p("div.td-post-date", "time"),
         card_date_attr="datetime",
         next_path=_p("div.page-nav td-pb-padding-side", "a"), next_child=_p("i.td-icon-menu-right"),
         title_path=_p("h3", "a"),
         body_path=_p("div.td-post-content"), date_path=_p("div.td-post-date", "time"), date_attr="datetime"),
    dict(site="JimBakkerShow", item_scope=_p("div.site-content"), item_path=_p("article", "h1.entry-title", "a"),
         next_first=True, next_path=_p("div.nav-previous alignleft button", "a"), title_path=_p("header.entry-header", "h1.entry-title"),
         body_path=_p("div.entry-content"), date_path=_p("footer.entry-meta", "time"), date_attr="datetime"),
    dict(site="Medicine-Today", item_path=_p("div.mvp-main-blog-out relative", "a"),
         title_path=_p("header#mvp-post-head", "h1.mvp-post-title entry-title"),
         body_path=_p("section#mvp-content-main"), date_path=_p("span.post-date updated", "time"), date_attr="datetime"),
    dict(site="NaturalHealth365", item_path=_p("div.article-container left", "div.title-meta-box", "a"),
         next_first=True, next_path=_p("nav.navigation", "div.nav-previous", "a"), title_path=_p("h1.entry-title"),
         body_path=_p("div.pf-content"), date_path=_p("span.entry-date")),
    dict(site="RealFarmacy", item_scope=_p("div.main-content-inner clearfix"), item_path=_p("div.entry-blog", "h2.page-title", "a"),
         next_first=True, next_path=_p("ul.post-nav", "li.nav-previous previous", "a"), title_path=_p("h2.page-title", "a"),
         body_path=_p("div.entry-summary blog-entry-summary")),
    dict(site="TheMindUnleashed", item_path=_p("div.article-card", "h3.article-card-title", "a"),
         title_path=_p("header", "h1.entry-title"), body_path=_p("div.article-copy"),
         date_path=_p("div.entry-meta-top", "time"), date_attr="datetime"),
    dict(site="TheTruthAboutCancer", item_path=_p("article", "header.entry-header", "a"),
         title_path=_p("header.entry-header", "h1.entry-title"), body_path=_p("div.entry-content"),
         date_path=_p("p.entry-meta"), date_after_tag="br"),
    dict(site="WND", item_path=_p("article", "div.entry-image", "a"),
         title_path=_p("header.entry-header", "h1.entry-title"), body_path=_p("div.entry-content"),
         date_path=_p("div.entry-meta", "span"), date_nth=1, date_after="Published "),
    dict(site="WorldHealth", item_path=_p("ul.item card result-item", "li.titleItem", "a"), link_root=True,
         title_path=_p("div.wrapper", "h1"), body_path=_p("div.oneNesBox"),
         date_path=_p("div.oneNesBox", "h5"), date_after="Posted on "),
    dict(site="ZeroHedge", item_path=_p("div.views-row", "span.views-field views-field-title", "a"), link_root=True,
         next_first=True, next_path=_p("nav.pager", "li.pager__item pager__item--next", "a"), title_path=_p("h1.page-title", "span"),
         body_path=_p("div.node__content"), date_path=_p("div.submitted-datetime", "span")),
    dict(site="generic", item_scope=_p("nav"), item_path=_p("a"), link_root=True, next_path=_p("nav", "a"),
         title_path=_p("h1"), body_path=_p("article"), body_tags=["p"]),
]
DEFAULT_BODY_TAGS = ["p", "li", "h1", "h2", "h3"]
# Start tags that close an open <p> (HTML rule); void elements never open.
P_CLOSERS = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset",
             "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
             "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section",
             "table", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"}
# ---------------------------------------------------------------------------


def _full_rule(r: dict) -> dict:
    full = {f.name: None for f in RULE.fields}
    full.update({"body_tags": DEFAULT_BODY_TAGS, "direct_only": False, "link_root": False,
                 "item_scope": [], "item_path": [], "card_title": [], "card_date": [], "next_first": False, "next_path": [], "next_child": [], "date_path": []})
    full.update(r)
    return full


def rules_frame(spark, rules=None) -> DataFrame:
    """The rule table as a DataFrame (one row per site; small and fixed)."""
    return spark.createDataFrame([_full_rule(r) for r in rules or SITE_RULES], RULE)


class _Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent


class _Tree(HTMLParser):
    """Element tree; an open <p> closes at the next block start tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {}, None)
        self.stack = [self.root]
        self.open = Counter()  # tags on the stack

    def handle_starttag(self, tag, attrs):
        if tag in P_CLOSERS and self.open["p"]:
            self._close("p")
        node = _Node(tag, dict(attrs), self.stack[-1])
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)
            self.open[tag] += 1

    def _close(self, tag):
        while True:
            last = self.stack.pop().tag
            self.open[last] -= 1
            if last == tag:
                return

    def handle_startendtag(self, tag, attrs):
        self.stack[-1].children.append(_Node(tag, dict(attrs), self.stack[-1]))

    def handle_endtag(self, tag):
        if self.open[tag]:
            self._close(tag)

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def _matches(node, step) -> bool:
    if step.get("tag") and node.tag != step["tag"]:
        return False
    if step.get("id") and node.attrs.get("id") != step["id"]:
        return False
    cls = step.get("cls")
    if cls:
        have = node.attrs.get("class") or ""
        return have == cls if " " in cls else cls in have.split()
    return True


def _walk(node):
    """Elements below a node in page order, without recursion."""
    todo = [iter(node.children)]
    while todo:
        c = next(todo[-1], None)
        if c is None:
            todo.pop()
        elif isinstance(c, _Node):
            yield c
            todo.append(iter(c.children))


def _find(node, step):
    return next((n for n in _walk(node) if _matches(n, step)), None)


def _find_path(node, path):
    for step in path or []:
        if node is None:
            return None
        node = _find(node, step)
    return node


def _find_all_path(node, path):
    """All matches of the last step inside the first match of the others."""
    if not path:
        return []
    head = _find_path(node, path[:-1])
    return [] if head is None else [n for n in _walk(head) if _matches(n, path[-1])]


def _text(node) -> str:
    out, todo = [], [iter(node.children)]
    while todo:
        c = next(todo[-1], None)
        if c is None:
            todo.pop()
        elif isinstance(c, str):
            out.append(c)
        else:
            todo.append(iter(c.children))
    return "".join(out)


def _items(root, rule: dict) -> list[tuple]:
    """(href, title, date) of every item container of a listing: its first
    anchor, and the card's own title and date where the rule names them."""
    out = []
    scope = _find_path(root, rule.get("item_scope"))
    path = rule.get("item_path") or []
    if scope is None or not path:
        return out
    for box in (n for n in _walk(scope) if _matches(n, path[0])):
        link = _find_path(box, path[1:])
        if link is None or not link.attrs.get("href"):
            continue
        title = _find_path(box, rule["card_title"]) if rule.get("card_title") else None
        date = _find_path(box, rule["card_date"]) if rule.get("card_date") else None
        attr = rule.get("card_date_attr")
        out.append((link.attrs["href"], _text(title) if title is not None else None,
                    None if date is None else date.attrs.get(attr) if attr else _text(date).strip()))
    return out


def extract_one(html: str, rule: dict) -> tuple:
    """(title, content, raw date, next href, item hrefs, item cards) of one page."""
    tree = _Tree()
    tree.feed(html or "")
    root = tree.root
    t = _find_path(root, rule.get("title_path"))
    title = _text(t) if t is not None else None
    body = _find_path(root, rule.get("body_path"))
    content = None
    if body is not None:
        tags = set(rule.get("body_tags") or DEFAULT_BODY_TAGS)
        if rule.get("direct_only"):
            parts = [c for c in body.children if isinstance(c, _Node) and c.tag in tags]
        else:
            parts = [n for n in _walk(body) if n.tag in tags]
        content = "\n".join(_text(n) for n in parts)
    date = None
    if rule.get("date_path"):
        found = _find_all_path(root, rule["date_path"])
        nth = rule.get("date_nth") or 0
        d = found[nth] if len(found) > nth else None
        if d is not None:
            mark = rule.get("date_after_tag") and _find(d, {"tag": rule["date_after_tag"]})
            if mark:  # the text that follows this element
                rest = mark.parent.children
                d = _Node(d.tag, d.attrs, d.parent)
                d.children = rest[next(i for i, c in enumerate(rest) if c is mark) + 1:]
            date = d.attrs.get(rule["date_attr"]) if rule.get("date_attr") else _text(d)
            after = rule.get("date_after")
            if date is not None and after:
                # the text between the marker and its next occurrence; no
                # marker -> no date
                parts = date.split(after)
                date = parts[1] if len(parts) > 1 else None
            date = date.strip() if date is not None else None
    nxt = _find_all_path(root, rule.get("next_path"))
    if rule.get("next_text"):
        nxt = [n for n in nxt if rule["next_text"] in _text(n)]
    if rule.get("next_child"):
        nxt = [n for n in nxt if _find_path(n, rule["next_child"]) is not None]
    # the last matching anchor wins, or the first where the rule says so
    nxt = nxt if rule.get("next_first") else nxt[::-1]
    nxt_href = next((n.attrs.get("href") for n in nxt if n.attrs.get("href")), None)
    cards = _items(root, rule)
    return title, content, date, nxt_href, [c[0] for c in cards], cards


EXTRACTED = StructType([
    StructField("page_id", LongType()), StructField("url", StringType()),
    StructField("site", StringType()), StructField("title", StringType()),
    StructField("content", StringType()), StructField("published_raw", StringType()),
    StructField("next_href", StringType()), StructField("item_hrefs", ArrayType(StringType())),
    StructField("item_cards", ArrayType(StructType([
        StructField("href", StringType()), StructField("title", StringType()), StructField("date", StringType())]))),
])


def _extract_batches(batches):
    import pandas as pd
    cache = {}
    for pdf in batches:
        out = []
        for page_id, url, site, html, rule_js in zip(pdf["page_id"], pdf["url"], pdf["site"],
                                                     pdf["html"], pdf["_rule"]):
            rule = cache.get(rule_js)
            if rule is None:
                rule = cache[rule_js] = json.loads(rule_js)
            out.append((page_id, url, site, *extract_one(html, rule)))
        yield pd.DataFrame(out, columns=[f.name for f in EXTRACTED.fields])


def _rule_map(rules) -> "F.Column":
    """site -> rule JSON as a map literal. The rule table is configuration,
    one row per site, so it travels inside the plan (no join)."""
    if isinstance(rules, DataFrame):
        rows = [r.asDict(recursive=True) for r in rules.collect()]  # bounded: one row per site
    else:
        rows = list(rules)
    pairs = []
    for r in rows:
        pairs += [F.lit(r["site"]), F.lit(json.dumps(r))]
    return F.create_map(*pairs)


def extract_articles(pages: DataFrame, rules=None, site_col: str = "site") -> DataFrame:
    """P12 tier (b): title, content, raw date, next link and listing links
    of every page by its site's rule (``rules``: the rule table or a list of
    rule dicts; default ``SITE_RULES``). Pages without a rule are dropped.
    The rule is looked up from a map literal, so pages are never joined or
    shuffled for it."""
    if rules is None:
        rules = [_full_rule(r) for r in SITE_RULES]
    elif not isinstance(rules, DataFrame):
        rules = [_full_rule(r) for r in rules]
    rule = F.element_at(_rule_map(rules), F.col(site_col))
    j = pages.select("page_id", "url", site_col, "html", rule.alias("_rule")).where(F.col("_rule").isNotNull())
    return j.mapInPandas(_extract_batches, EXTRACTED)


def next_link(pages: DataFrame, container: str = "nav", rules=None, site_col: str = "site") -> DataFrame:
    """``(page_id, next_url)``, the page's "next" link made absolute
    (NULL when there is none). Tier (a): the last link inside
    ``container``. With ``rules``: each site's next-page rule (tier b; the
    last matching anchor wins)."""
    if rules is not None:
        ex = extract_articles(pages, rules, site_col)
        nxt = F.col("next_href")
        return ex.select("page_id", F.when(nxt.isNotNull(), absolute_url(nxt, F.col("url"))).alias("next_url"))
    last = F.try_element_at(hrefs(inner_html("html", container)), F.lit(-1))
    return pages.select("page_id", F.when(last.isNotNull(), absolute_url(last, F.col("url"))).alias("next_url"))


def extract_links(pages: DataFrame, container: str | None = None) -> DataFrame:
    """P13 tier (a): ``(page_id, link)`` for every href (inside
    ``container`` when given), relative links made absolute."""
    src = inner_html("html", container) if container else F.col("html")
    ex = pages.select("page_id", "url", F.explode(hrefs(src)).alias("href"))
    return ex.select("page_id", absolute_url("href", "url").alias("link"))


def ordered_links(pages: DataFrame, container: str | None = None) -> DataFrame:
    """P13 tier (a) in page order: ``(url, link_pos, link)``."""
    src = inner_html("html", container) if container else F.col("html")
    ex = pages.select("url", F.posexplode(hrefs(src)).alias("link_pos", "href"))
    return ex.select("url", "link_pos", absolute_url("href", "url").alias("link"))


def listing_links(pages: DataFrame, rules=None, site_col: str = "site") -> DataFrame:
    """P13 tier (b): distinct article links of listing pages by each site's
    item rule, relative ones made absolute (sites that link relative set
    ``link_root``; absolute links pass through unchanged)."""
    ex = extract_articles(pages, rules, site_col)
    links = ex.select("url", F.explode("item_hrefs").alias("href"))
    return links.select(absolute_url("href", "url").alias("link")).dropDuplicates(["link"])


def cut_cards(pages: DataFrame, rules=None, site_col: str = "site") -> DataFrame:
    """P15, first half: ``(page_id, site, pos, link, title, date)`` for every
    item of a listing page, cut by the site's item rule."""
    ex = extract_articles(pages, rules, site_col)
    cards = ex.select("page_id", "site", "url", F.posexplode("item_cards").alias("pos", "c"))
    return cards.select("page_id", "site", "pos", absolute_url(F.col("c.href"), F.col("url")).alias("link"), "c.title", "c.date")


def listing_cards(cards: DataFrame, key: str, seq: str, cols: list[str]) -> DataFrame:
    """Per ``key`` (an article URL or a host), the card fields seen
    last in ``seq`` order win. ``max_by`` aggregates map-side first."""
    agg = cards.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(seq)).alias("_c"))
    return agg.select(key, *[F.col(f"_c.{c}").alias(c) for c in cols])
