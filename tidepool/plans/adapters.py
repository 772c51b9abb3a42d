"""Adapters: give the driver's tables the shapes of the reference's stores.

Each adapter reads whole tables; arithmetic on ids only derives attribute
values (tags, kinds, reshare parents, uncollected parents, JSON media) that
the synthetic tables lack, and store states come from joins with other
tables. The SQL twins in ``tidepool.plans.oracle`` use the same expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.html import first_tag_text, inner_html, paragraphs
from tidepool.functions.urls import host_of

TS0 = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


# Tables whose rows carry long text (regex work per row dominates).
TEXT_TABLES = {"documents", "pages"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread_coarse_input(df) if name in TEXT_TABLES else df


def spread_coarse_input(df: DataFrame) -> DataFrame:
    """As read, unless the caller sets ``spark.tidepool.textPartitions``
    (the bench does: its small tables are one file each)."""
    n = df.sparkSession.conf.get("spark.tidepool.textPartitions", None)
    return df.repartition(int(n)) if n else df


def tweets(spark, sf_dir, urls: bool = True) -> DataFrame:
    """Stored tweets (hydrated shape) from ``documents``; URLs from ``pages``
    (the join is left out when the caller does not use ``expanded_urls``)."""
    t = table(spark, sf_dir, "documents")
    if urls:
        p = table(spark, sf_dir, "pages").select("page_id", "url")
        t = t.join(p, t.doc_id == p.page_id, "left")
    else:
        t = t.withColumn("url", F.lit(None).cast("string"))
    i = F.col("doc_id")
    return t.select(
        "doc_id",
        i.cast("string").alias("tweet_id"),
        (i % 97).cast("string").alias("author_id"),
        F.expr(f"{TS0} + doc_id * INTERVAL '20' MINUTE").alias("created_at"),
        "text", "lang", "source",
        F.concat_ws(",", F.when(i % 3 == 0, F.lit("#Covid19")),
                    F.when(i % 4 == 0, F.lit("#2020Election")),
                    F.concat(F.lit("#"), "source")).alias("hashtags_str"),
        F.concat_ws(",", F.concat(F.lit("@User"), (i % 13).cast("string")),
                    F.when(i % 5 == 0, F.concat(F.lit("@user"), (i % 7).cast("string")))).alias("mentions_str"),
        F.coalesce("url", F.lit("")).alias("expanded_urls"),
        (i % 50).alias("like_count"),
        (i % 11).alias("retweet_count"),
        F.when(i % 10 == 8, "retweet").when(i % 10 == 9, "reply").otherwise("regular").alias("kind"),
    )


def regular(spark, sf_dir, urls: bool = True) -> DataFrame:
    """Original tweets: first turn of each conversation; the linked URL is
    the page with the conversation's id (joined only when asked for)."""
    c = table(spark, sf_dir, "conversations").where("turn = 0")
    if urls:
        p = table(spark, sf_dir, "pages").select("page_id", "url")
        j = c.join(p, c.conv_id == p.page_id, "left")
    else:
        j = c.withColumn("url", F.lit(None).cast("string"))
    return j.select(
        (F.col("conv_id") * 100).cast("string").alias("tweet_id"),
        ((F.col("conv_id") * 13) % 400).cast("string").alias("author_id"),
        "text",
        F.coalesce("url", F.lit("")).alias("expanded_urls"),
        (F.col("conv_id") % 9).alias("retweet_count"),
    )


def _parent(tid):
    """The turn before; in every seventh conversation (conv_id % 7 = 3)
    turn 2 reshares a post that was never collected (id ...99), so its
    chain is broken."""
    lost = (F.col("conv_id") % 7 == 3) & (F.col("turn") == 2)
    return F.when(lost, F.col("conv_id") * 100 + 99).otherwise(tid - 1).cast("string")


def retweets(spark, sf_dir) -> DataFrame:
    """Reshares: every later turn of a conversation."""
    c = table(spark, sf_dir, "conversations").where("turn > 0")
    tid = F.col("conv_id") * 100 + F.col("turn")
    return c.select(
        tid.cast("string").alias("tweet_id"),
        ((F.col("conv_id") * 13 + F.col("turn") * 29) % 400).cast("string").alias("author_id"),
        _parent(tid).alias("parent_tweet_id"),
        "text",
    )


def posts(spark, sf_dir) -> DataFrame:
    """Originals and reshares as one table ``(tweet_id, parent_tweet_id, kind)``."""
    reg = regular(spark, sf_dir, urls=False).select("tweet_id", F.lit(None).cast("string").alias("parent_tweet_id"), F.lit("regular").alias("kind"))
    return reg.unionByName(retweets(spark, sf_dir).select("tweet_id", "parent_tweet_id", F.lit("retweet").alias("kind")))


def id_list(spark, sf_dir) -> DataFrame:
    """A tweet-ID list to hydrate: every labelled document, plus ids taken
    from the pages (offset by 10^6) that the archive does not hold."""
    l = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("tweet_id"))
    p = table(spark, sf_dir, "pages").select((F.col("page_id") + 1000000).cast("string").alias("tweet_id"))
    return l.unionByName(p)


def archive(spark, sf_dir) -> DataFrame:
    """The hydration archive: every document as a full record."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("string").alias("tweet_id"), "lang", "source")


def scores(spark, sf_dir) -> DataFrame:
    l = table(spark, sf_dir, "labels")
    return l.select(F.col("doc_id").cast("string").alias("author_id"),
                    F.col("toxic").cast("double").alias("score"))


def full_ids(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("string").alias("tweet_id"), "lang")


def clean_ids(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return (d.join(good, "doc_id", "left_semi")
            .select(F.col("doc_id").cast("string").alias("tweet_id"), "lang"))


def article_pages(spark, sf_dir) -> DataFrame:
    """Pages rendered as article rows: source host, <h1> title, paragraphs."""
    from tidepool.sources.files import read_pages
    p = spread_coarse_input(read_pages(spark, f"{sf_dir.rstrip('/')}/pages.parquet"))
    art = inner_html(F.col("html"), "article")
    return p.select(
        "page_id", "url",
        host_of(F.col("url")).alias("source"),
        first_tag_text(art, "h1").alias("title"),
        F.array_join(paragraphs(art), "\n").alias("content"),
    )


def listing_pages(spark, sf_dir) -> DataFrame:
    """The pages as listings ``(page_id, url, html)``: each has an address of
    its own and, after its body, a pager with the
    link to the page that follows, in runs of 40 pages. The last page of a run
    has no pager, leads back into its run or on to a page that is not there."""
    p = table(spark, sf_dir, "pages")
    i, last = F.col("page_id"), F.col("page_id") % 40 == 39
    turn = F.floor(i / 40) % 3
    to = F.when(~last, i + 1).when(turn == 1, i - 17).when(turn == 2, i + 10_000_000)
    pager = F.concat(F.lit('<aside><a href="/list/1">first</a><a href="https://lists.example/list/'), to.cast("string"), F.lit('">next</a></aside>'))
    return p.select("page_id", F.concat(F.lit("https://lists.example/list/"), i.cast("string")).alias("url"),
                    F.concat("html", F.coalesce(pager, F.lit(""))).alias("html"))


def listing_starts(spark, sf_dir) -> DataFrame:
    """The addresses the walks begin at: the first page of each run, one
    inside it, and one page that is not there."""
    p = table(spark, sf_dir, "pages").where("page_id % 40 IN (0, 25)")
    i = F.when(F.col("page_id") % 400 == 25, F.col("page_id") + 10_000_000).otherwise(F.col("page_id"))
    return p.select(F.concat(F.lit("https://lists.example/list/"), i.cast("string")).alias("url"))


def articles_in(spark, sf_dir) -> DataFrame:
    """A scraped batch: every page from the site listings, plus the pages
    that conversations link to, scraped again from a second listing under
    a new row number (duplicate URLs inside the batch). The publish date is
    raw text whose shape goes with ``row % 7``: ISO day, ISO time, long and
    short month names, one named site's decorated form, none, and a text
    without a date (rejected by the load)."""
    a = article_pages(spark, sf_dir)
    linked = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("page_id")).distinct()
    again = a.join(linked, "page_id", "left_semi").withColumn("page_id", F.col("page_id") + 1000000)
    both = a.unionByName(again).withColumnRenamed("page_id", "row")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("row") % 1000).cast("int"))
    shape = F.col("row") % 7
    raw = (F.when(shape == 0, F.date_format(day, "yyyy-MM-dd"))
           .when(shape == 1, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T08:30:00-05:00")))
           .when(shape == 2, F.date_format(day, "MMMM d, yyyy"))
           .when(shape == 3, F.date_format(day, "MMM d, yyyy"))
           .when(shape == 4, F.concat(F.date_format(day, "EEE, MM/dd/yyyy"), F.lit(" - 17:48")))
           .when(shape == 6, F.lit("3 hours ago")))
    return both.withColumn("source", F.when(shape == 4, "ZeroHedge").otherwise(F.col("source"))) \
        .withColumn("publishedAt", raw)


def articles_existing(spark, sf_dir) -> DataFrame:
    """The store before the load: the pages already labelled (a label row
    with the page's id), with ids 0..n-1 in page order."""
    a = article_pages(spark, sf_dir)
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"))
    from tidepool.operators.keyed import assign_ids
    stored = assign_ids(a.join(labelled, "page_id", "left_semi"), 0, ["page_id"])
    return stored.select("article_id", "title", "source", "content",
                         F.lit(None).cast("string").alias("publishedAt"), "url", F.lit("unknown").alias("label"))


# ---------------------------------------------------------------------------
# The date shapes of the sites, chosen by o_orderkey % 7.
RAW_DATE_SHAPES = [
    ("Medicine-Today", "yyyy-MM-dd", ""),
    ("TheMindUnleashed", "yyyy-MM-dd'T'HH:mm:ss", "-05:00"),
    ("HealthImpactNews", "MMMM d, yyyy", ""),
    ("HealthNutNews", "MMM d, yyyy", ""),
    ("WND", "MMMM d, yyyy", " at 1:40pm"),
    ("WorldHealth", "MMM d, yyyy", ",  2 p.m."),
    ("ZeroHedge", "EEE, MM/dd/yyyy", " - 17:48"),
]
# ---------------------------------------------------------------------------


def raw_dates(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 7
    src = F.lit(None).cast("string")
    txt = F.lit(None).cast("string")
    for n, (site, fmt, suffix) in reversed(list(enumerate(RAW_DATE_SHAPES))):
        src = F.when(k == n, F.lit(site)).otherwise(src)
        txt = F.when(k == n, F.concat(F.date_format("o_orderdate", fmt), F.lit(suffix))).otherwise(txt)
    return o.select("o_orderkey", src.alias("source"), txt.alias("raw_date"))


def base_balances(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("value"))


def balance_updates(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("key"), "value", "ts", "event_id")


def conversation_archive(spark, sf_dir) -> DataFrame:
    """Every conversation turn as a tweet for the ingest walk: turn 0 is
    the original, turn % 3 = 1 a reply, other turns reshares; parents as in
    ``retweets`` (some never collected)."""
    c = table(spark, sf_dir, "conversations")
    tid = F.col("conv_id") * 100 + F.col("turn")
    return c.select(
        tid.cast("string").alias("tweet_id"),
        F.when(F.col("turn") == 0, F.lit(None).cast("string")).otherwise(_parent(tid))
        .alias("parent_tweet_id"),
        F.when(F.col("turn") == 0, "regular").when(F.col("turn") % 3 == 1, "reply")
        .otherwise("retweet").alias("kind"),
    )


def conversation_seeds(spark, sf_dir) -> DataFrame:
    """Last turn of each conversation, as seen by the stream."""
    c = table(spark, sf_dir, "conversations")
    last = c.groupBy("conv_id").agg(F.max("turn").alias("turn"))
    return last.select((F.col("conv_id") * 100 + F.col("turn")).cast("string").alias("tweet_id"))


# --- tweet JSON in the reference's two shapes --------------------------------

def _strip_first(arr):
    return F.transform(arr, lambda x: F.substring(x, 2, 1 << 30))


def _video_variants(i):
    b1 = F.when(i % 8 == 1, F.lit(None)).otherwise((i % 3 + 1) * 100000).cast("long")
    b2 = (F.when(i % 8 == 1, F.lit(None)).when(i % 8 == 0, b1)
          .otherwise((i % 2 + 1) * 150000)).cast("long")
    base = F.concat(F.lit("https://video.example/"), i.cast("string"))
    return F.array(
        F.struct(b1.alias("bitrate"), F.concat(base, F.lit("/a.mp4")).alias("url")),
        F.struct(F.lit(None).cast("long").alias("bitrate"), F.concat(base, F.lit("/pl.m3u8")).alias("url")),
        F.struct(b2.alias("bitrate"), F.concat(base, F.lit("/b.mp4")).alias("url")))


def v1_json(spark, sf_dir) -> DataFrame:
    """``(doc_id, value)``: each tweet as a v1.1 JSON object. Media by
    doc_id % 4: video, animated GIF, photo, none (links only); a bitrate tie
    when doc_id % 8 = 0, no bitrate at all when doc_id % 8 = 1."""
    t = tweets(spark, sf_dir)
    i = F.col("doc_id")
    tags = _strip_first(F.filter(F.split("hashtags_str", ","), lambda x: x != ""))
    ments = _strip_first(F.filter(F.split("mentions_str", ","), lambda x: x != ""))
    urls = F.when(F.col("expanded_urls") != "", F.array(F.struct(F.col("expanded_urls").alias("expanded_url")))) \
        .otherwise(F.array().cast("array<struct<expanded_url:string>>"))
    kind4 = i % 4
    vtype = F.when(kind4 == 0, "video").otherwise("animated_gif")
    photo = F.struct(F.lit("photo").alias("type"),
                     F.concat(F.lit("https://img.example/"), i.cast("string"), F.lit(".jpg")).alias("media_url"),
                     F.lit(None).cast("struct<variants:array<struct<bitrate:bigint,url:string>>>").alias("video_info"))
    video = F.struct(vtype.alias("type"), F.lit(None).cast("string").alias("media_url"),
                     F.struct(_video_variants(i).alias("variants")).alias("video_info"))
    ext = (F.when(kind4 == 2, F.struct(F.array(photo).alias("media")))
           .when(kind4 <= 1, F.struct(F.array(video).alias("media"))))
    parent = (i - 1)
    obj = F.struct(
        F.col("tweet_id").alias("id_str"), F.col("text").alias("text"), F.col("text").alias("full_text"),
        F.array((i % 5).cast("int"), F.length("text").cast("int")).alias("display_text_range"),
        F.date_format("created_at", "EEE MMM dd HH:mm:ss '+0000' yyyy").alias("created_at"),
        F.col("lang"), F.col("like_count").alias("favorite_count"), F.col("retweet_count"),
        (i % 7).alias("quote_count"), (i % 3).alias("reply_count"),
        F.struct(F.col("author_id").alias("id_str")).alias("user"),
        F.struct(F.transform(tags, lambda x: F.struct(x.alias("text"))).alias("hashtags"),
                 F.transform(ments, lambda x: F.struct(x.alias("screen_name"))).alias("user_mentions"),
                 urls.alias("urls")).alias("entities"),
        ext.alias("extended_entities"),
        F.when(F.col("kind") == "retweet", F.struct(
            parent.cast("string").alias("id_str"),
            F.struct((parent % 97).cast("string").alias("id_str")).alias("user"))).alias("retweeted_status"),
    )
    return t.select("doc_id", F.to_json(obj).alias("value"))


def v2_json(spark, sf_dir) -> DataFrame:
    """``(doc_id, value)``: each tweet as a v2 envelope. Retweets reference
    ``doc_id - 1`` (``includes`` missing when doc_id % 20 = 18); replies
    quote ``doc_id - 2`` and reply to ``doc_id - 1``; doc_id % 10 = 7 only
    quotes. Every 11th record (doc_id % 11 = 0) is cut short."""
    t = tweets(spark, sf_dir)
    i = F.col("doc_id")
    kind = F.col("kind")
    ref = lambda typ, off: F.struct(F.lit(typ).alias("type"), (i - off).cast("string").alias("id"))
    refs = (F.when(kind == "retweet", F.array(ref("retweeted", 1)))
            .when(kind == "reply", F.array(ref("quoted", 2), ref("replied_to", 1)))
            .when(i % 10 == 7, F.array(ref("quoted", 3))))
    url = F.col("expanded_urls")
    urls = F.when(url != "", F.array(F.struct(
        url.alias("expanded_url"),
        F.when(i % 2 == 0, F.concat(url, F.lit("#u"))).alias("unwound_url")))) \
        .otherwise(F.array().cast("array<struct<expanded_url:string,unwound_url:string>>"))
    tags = _strip_first(F.filter(F.split("hashtags_str", ","), lambda x: x != ""))
    ments = _strip_first(F.filter(F.split("mentions_str", ","), lambda x: x != ""))
    data = F.struct(
        F.col("tweet_id").alias("id"), F.col("author_id"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("created_at"),
        F.col("text"),
        F.struct(F.col("like_count"), (i % 7).alias("quote_count"), (i % 3).alias("reply_count"),
                 F.col("retweet_count")).alias("public_metrics"),
        refs.alias("referenced_tweets"),
        F.struct(urls.alias("urls"),
                 F.transform(tags, lambda x: F.struct(x.alias("tag"))).alias("hashtags"),
                 F.transform(ments, lambda x: F.struct(x.alias("username"))).alias("mentions")).alias("entities"))
    includes = F.when((kind == "retweet") & (i % 20 != 18), F.struct(F.array(F.struct(
        (i - 1).cast("string").alias("id"), ((i - 1) % 97).cast("string").alias("author_id"))).alias("tweets")))
    js = F.to_json(F.struct(data.alias("data"), includes.alias("includes")))
    js = F.when(i % 11 == 0, F.expr("substring(_js, 1, length(_js) div 2)")).otherwise(F.col("_js"))
    return t.select("doc_id", F.to_json(F.struct(data.alias("data"), includes.alias("includes"))).alias("_js")) \
        .select("doc_id", js.alias("value"))
