"""Check queries: one Spark plan per operator family, over whole tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names equal those of its SQL twin in ``tidepool.plans.oracle``.
Counts are bigint, timestamps and dates are rendered as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.dates import normalize_date
from tidepool.functions.html import first_tag_text, inner_html
from tidepool.functions.text import clean_text as clean_col
from tidepool.functions.urls import host_of
from tidepool.operators import chains, keyed, predicates as pr, stats, windows
from tidepool.plans import adapters as ad

TS_FMT = "yyyy-MM-dd HH:mm:ss"

# ---------------------------------------------------------------------------
# Fixed parameters of the checks.
SEARCH_RULES = ["#covid19 #2020election", "#2020election has:links lang:en -is:retweet"]
ANY_TERMS = ["nicht", "mentre", "thnd"]
RECENT_NOW = "2024-01-15 00:00:00"
MISSING_MONTH = "2024-01"
CAP_PER_DAY = 20
PAGE_SIZE = 7
RT_START, RT_END = "2024-01-02 00:00:00", "2024-01-09 00:00:00"
# hashtag searches: target table -> tags (all required), English only;
# result pages of SEARCH_PAGE rows per day until SEARCH_PER_DAY are reached
HASHTAG_TABLES = {"covid19_truncated": ["#covid19"], "election2020_truncated": ["#2020election"],
                  "both_truncated": ["#covid19", "#2020election"]}
SEARCH_PAGE, SEARCH_PER_DAY = 5, 12
# ---------------------------------------------------------------------------

QUERIES: dict[str, callable] = {}


def query(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _ts(c):
    return F.date_format(F.col(c), TS_FMT)


def _landing(spark, name: str, sf: str, write) -> str:
    """Input files a check reads (JSON lines, ID lists, TSVs), landed anew
    from the given tables by every run."""
    from tidepool.session import scratch_path
    path = scratch_path(spark, name)
    write(path)
    return path


# --- text and rankings ------------------------------------------------------

@query("clean_text")
def q_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    d = ad.table(spark, sf, "documents")
    return d.select("doc_id", clean_col("text").alias("clean"))


@query("word_top20")
def q_word_top20(spark, sf):
    return stats.top_words(ad.tweets(spark, sf, urls=False), "text", 20)


@query("hashtag_top20")
def q_hashtag_top20(spark, sf):
    return stats.top_tags(ad.tweets(spark, sf, urls=False), "hashtags_str", 20)


@query("mention_top20")
def q_mention_top20(spark, sf):
    return stats.top_mentions(ad.tweets(spark, sf, urls=False), "mentions_str", 20)


# --- filters ----------------------------------------------------------------

@query("select_where")
def q_select_where(spark, sf):
    t = ad.tweets(spark, sf, urls=False)
    return pr.select_where(t, ["tweet_id", "lang", "like_count"], "like_count >= 25")


@query("retweets_only")
def q_retweets_only(spark, sf):
    t = pr.only_retweets(ad.tweets(spark, sf, urls=False))
    return t.select("tweet_id", "author_id", _ts("created_at").alias("created_at"))


@query("any_term")
def q_any_term(spark, sf):
    d = ad.table(spark, sf, "documents")
    return pr.any_term(d, "text", ANY_TERMS).select("doc_id")


@query("search_rules")
def q_search_rules(spark, sf):
    return pr.match_rules(ad.tweets(spark, sf), SEARCH_RULES).select("tweet_id")


@query("union_distinct")
def q_union_distinct(spark, sf):
    t = ad.tweets(spark, sf, urls=False).select("tweet_id", "lang", "like_count", "kind")
    hits = [pr.lang_is(t, "en"), t.where("like_count >= 40"), t.where("kind = 'reply'")]
    return pr.union_distinct([h.select("tweet_id", "lang") for h in hits])


@query("recent_window")
def q_recent_window(spark, sf):
    t = ad.tweets(spark, sf, urls=False)
    w = pr.recent_window(t, "created_at", RECENT_NOW, days=7, margin_minutes=1)
    w = pr.match_rules(pr.non_replies(w), ["-is:retweet"])
    return w.select("tweet_id", _ts("created_at").alias("created_at"))


@query("take_while_sorted")
def q_take_while_sorted(spark, sf):
    o = ad.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return pr.take_while_sorted(o, "o_custkey", "o_orderkey", "o_orderdate").select("o_orderkey")


@query("take_while_sorted_spread")
def q_take_while_sorted_spread(spark, sf):
    """F12 through its hot-part path (range-partitioned ordered scan),
    over more slices than the session's partitions."""
    o = ad.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return pr.take_while_sorted(o, "o_custkey", "o_orderkey", "o_orderdate", num_partitions=13).select("o_orderkey")


# --- ID sets ----------------------------------------------------------------

def _landed_daily(spark, sf) -> DataFrame:
    """Land ``full`` and ``clean`` ID sets as daily TSVs (one folder per
    day; the clean set under a ``_clean`` name) and read them back (S3)."""
    from tidepool.sources.files import read_daily_tsv, write_daily_tsv

    def write(root):
        day = F.date_format("created_at", "yyyy-MM-dd").alias("day")
        t = ad.tweets(spark, sf, urls=False).select("tweet_id", "lang", day)
        good = ad.table(spark, sf, "labels").where("quality = 1").select(
            F.col("doc_id").cast("string").alias("tweet_id"))
        # no repartition by day before writing: a day may hold a third of all rows
        write_daily_tsv(t, f"{root}/full", mode="overwrite")
        write_daily_tsv(t.join(good, "tweet_id", "left_semi"), f"{root}/ids_clean", mode="overwrite")
    return read_daily_tsv(spark, _landing(spark, "daily", sf, write), ["tweet_id", "lang", "day"])


@query("daily_source_ids")
def q_daily_source_ids(spark, sf):
    d = _landed_daily(spark, sf)
    return pr.lang_is(d.where("variant = 'clean'"), "en").select("tweet_id")


@query("daily_retweet_ids")
def q_daily_retweet_ids(spark, sf):
    from tidepool.operators.keyed import retweet_ids
    d = _landed_daily(spark, sf)
    return retweet_ids(d.where("variant = 'full'"), d.where("variant = 'clean'"))


def _label_ids(spark, sf):
    return ad.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("tweet_id"))


@query("hydrate")
def q_hydrate(spark, sf):
    return keyed.hydrate(ad.id_list(spark, sf), ad.archive(spark, sf))


@query("hydrate_slices")
def q_hydrate_slices(spark, sf):
    """J3 + T6: a run that a quota stops after a few slices, then one that
    does the rest."""
    from tidepool.operators.hydration import hydrate_slices, hydrated
    from tidepool.session import scratch_path
    out, archive = scratch_path(spark, "hydration"), ad.archive(spark, sf)
    for quota in (5, None):
        hydrate_slices(ad.id_list(spark, sf), archive, out, slices=16, wave=8, stop_after=quota)
    return hydrated(spark, out, "tweet_id string, lang string, source string")


@query("unhydrated")
def q_unhydrated(spark, sf):
    return keyed.unhydrated(ad.id_list(spark, sf), ad.archive(spark, sf))


@query("orphans")
def q_orphans(spark, sf):
    """Reshares whose declared parent (tweet_id of a stored post) is absent."""
    reg, rts = _chains(spark, sf)
    stored = reg.select("tweet_id").unionByName(rts.select("tweet_id"))
    return keyed.orphans(rts.select("tweet_id", "parent_tweet_id"), stored, "parent_tweet_id", "tweet_id")


# --- keyed writes -----------------------------------------------------------

@query("append_new")
def q_append_new(spark, sf):
    c = ad.table(spark, sf, "conversations")
    batch = c.select(F.col("conv_id").cast("string").alias("tweet_id"), "turn", "role")
    stored = _label_ids(spark, sf)
    return keyed.append_new(batch, stored, ["tweet_id"], ["turn"])


@query("update_stats")
def q_update_stats(spark, sf):
    base = ad.base_balances(spark, sf)
    upd = ad.balance_updates(spark, sf)
    return keyed.update_by_key(base, upd, "key", ["value"], ["ts", "event_id"])


@query("update_text")
def q_update_text(spark, sf):
    base = keyed.ensure_column(ad.base_balances(spark, sf), "text", "string")
    upd = ad.table(spark, sf, "events").select(
        F.col("user_id").alias("key"), F.col("event_type").alias("text"), "ts", "event_id")
    return keyed.update_by_key(base, upd, "key", ["text"], ["ts", "event_id"])


@query("retweet_text_update")
def q_retweet_text_update(spark, sf):
    """P17 + J9 on the reshare store: the table lacks ``text``; it is added,
    then filled from fetched records by ``tweet_id`` (rows without a fetched
    record keep NULL)."""
    reg, rts = _chains(spark, sf)
    store = keyed.ensure_column(rts.select("tweet_id", "author_id", "parent_tweet_id"), "text", "string")
    c = ad.table(spark, sf, "conversations")
    fetched = c.select((F.col("conv_id") * 100 + F.col("turn")).cast("string").alias("tweet_id"), "text",
                       F.lit(0).alias("seq"))
    return keyed.update_by_key(store, fetched, "tweet_id", ["text"], ["seq"])


def _loaded(spark, sf):
    from tidepool.operators.articles import load_articles
    existing = ad.articles_existing(spark, sf)
    new, _ = load_articles(ad.articles_in(spark, sf), existing)
    return existing, new


@query("load_articles")
def q_load_articles(spark, sf):
    _, new = _loaded(spark, sf)
    return new


@query("load_rejects")
def q_load_rejects(spark, sf):
    from tidepool.operators.articles import load_articles
    _, rejects = load_articles(ad.articles_in(spark, sf), ad.articles_existing(spark, sf))
    return rejects.select(F.col("row").alias("listing_row"), "source", "url", "publishedAt")


@query("load_report")
def q_load_report(spark, sf):
    from tidepool.operators.articles import report
    existing, new = _loaded(spark, sf)
    return report(existing, new)


# --- windows ----------------------------------------------------------------

@query("cap_per_day")
def q_cap_per_day(spark, sf):
    e = ad.table(spark, sf, "events")
    return windows.cap_per_day(e, "ts", CAP_PER_DAY, "event_id").select("event_id")


@query("cap_pages_per_day")
def q_cap_pages_per_day(spark, sf):
    e = ad.table(spark, sf, "events")
    return windows.cap_pages_per_day(e, "ts", PAGE_SIZE, CAP_PER_DAY, "event_id").select("event_id")


@query("hashtag_search")
def q_hashtag_search(spark, sf):
    """Per-table hashtag searches (F1 F2 W3): English tweets holding all
    of a table's tags, newest first, whole pages per day up to the daily
    target; one frame with the target table named per row."""
    t = pr.lang_is(ad.tweets(spark, sf, urls=False), "en")
    parts = [windows.cap_pages_per_day(pr.has_all_tags(t, tags), "created_at", SEARCH_PAGE, SEARCH_PER_DAY,
                                       "tweet_id", newest_first=True)
             .select(F.lit(name).alias("table"), "tweet_id")
             for name, tags in HASHTAG_TABLES.items()]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


# --- dates ------------------------------------------------------------------

@query("date_normalize")
def q_date_normalize(spark, sf):
    r = ad.raw_dates(spark, sf)
    return r.select("o_orderkey", F.date_format(normalize_date("raw_date", F.col("source")), "yyyy-MM-dd")
                    .alias("published"))


@query("missing_days")
def q_missing_days(spark, sf):
    from tidepool.sources.calendar import missing_days
    e = ad.table(spark, sf, "events")
    have = e.select(F.to_date("ts").alias("day"))
    return missing_days(have, MISSING_MONTH).select(F.date_format("day", "yyyy-MM-dd").alias("day"))


# --- pages ------------------------------------------------------------------

@query("page_title")
def q_page_title(spark, sf):
    return ad.article_pages(spark, sf).select("page_id", "title")


@query("page_content")
def q_page_content(spark, sf):
    return ad.article_pages(spark, sf).select("page_id", "content")


@query("links")
def q_links(spark, sf):
    from tidepool.operators.html_extract import extract_links
    return stats.distinct_links(extract_links(ad.table(spark, sf, "pages")), "link")


@query("listing_last_wins")
def q_listing_last_wins(spark, sf):
    p = ad.table(spark, sf, "pages")
    cards = p.select(host_of("url").alias("host"), "page_id",
                     first_tag_text(inner_html("html", "article"), "h1").alias("title"))
    from tidepool.operators.html_extract import listing_cards
    return listing_cards(cards, "host", "page_id", ["title"])


# --- chains -----------------------------------------------------------------

def _chains(spark, sf, urls: bool = False):
    reg = ad.regular(spark, sf, urls=urls)
    rts = ad.retweets(spark, sf)
    return reg, rts


@query("direct_undirect")
def q_direct_undirect(spark, sf):
    reg, rts = _chains(spark, sf)
    return chains.parent_kind(rts, reg)


@query("retweet_roots")
def q_retweet_roots(spark, sf):
    reg, rts = _chains(spark, sf)
    return chains.resolve_roots(rts, reg)


@query("retweets_per_root")
def q_retweets_per_root(spark, sf):
    reg, rts = _chains(spark, sf)
    return chains.retweets_per_root(chains.resolve_roots(rts, reg))


@query("collection_gap")
def q_collection_gap(spark, sf):
    reg, rts = _chains(spark, sf)
    return chains.collection_gap(chains.resolve_roots(rts, reg), reg)


@query("dataset_summary")
def q_dataset_summary(spark, sf):
    reg, rts = _chains(spark, sf)
    roots = chains.resolve_roots(rts, reg)
    return chains.chain_summary(rts, reg, roots, chains.parent_kind(rts, reg))


@query("topk_words")
def q_topk_words(spark, sf):
    reg, rts = _chains(spark, sf)
    return chains.topk_words(chains.resolve_roots(rts, reg), reg)


@query("site_top20")
def q_site_top20(spark, sf):
    reg, rts = _chains(spark, sf, urls=True)
    return chains.site_top(chains.resolve_roots(rts, reg), reg, 100, 20)


@query("bot_share")
def q_bot_share(spark, sf):
    reg, rts = _chains(spark, sf)
    return chains.bot_share(chains.resolve_roots(rts, reg), rts, ad.scores(spark, sf))


@query("ingest_closure")
def q_ingest_closure(spark, sf):
    return chains.ingest_closure(ad.conversation_seeds(spark, sf), ad.conversation_archive(spark, sf))


# --- tweet JSON -------------------------------------------------------------

def _landed_json(spark, sf, version: int) -> DataFrame:
    """Land the adapter's JSON lines as files in the shared scratch folder
    and read them back through the JSON source (S5)."""
    from tidepool.sources.tweets_json import read_tweets_v1, read_tweets_v2

    def write(path):
        src = ad.v1_json(spark, sf) if version == 1 else ad.v2_json(spark, sf)
        src.select("value").write.mode("overwrite").text(path)
    path = _landing(spark, f"tweets_v{version}", sf, write)
    return read_tweets_v1(spark, path) if version == 1 else read_tweets_v2(spark, path)


@query("parse_v1")
def q_parse_v1(spark, sf):
    from tidepool.operators.parse import parse_tweet_v1
    return parse_tweet_v1(_landed_json(spark, sf, 1), extended=True)


@query("parse_retweet_v1")
def q_parse_retweet_v1(spark, sf):
    from tidepool.operators.parse import parse_retweet_v1
    return parse_retweet_v1(_landed_json(spark, sf, 1))


@query("retweet_search")
def q_retweet_search(spark, sf):
    """A window search that keeps only retweets (P3 F6 F8 K1): v1.1 JSON,
    retweets created in [RT_START, RT_END) UTC, not already stored."""
    from tidepool.functions.dates import tweet_time
    from tidepool.operators.parse import parse_retweet_v1
    rts = parse_retweet_v1(_landed_json(spark, sf, 1)).where("is_retweet")
    win = pr.time_range_utc(rts.withColumn("_t", tweet_time("created_at")), "_t", RT_START, RT_END).drop("_t")
    new = keyed.append_new(win, _label_ids(spark, sf), ["tweet_id"], ["created_at", "tweet_id"])
    return new.select("tweet_id", "author_id", "parent_tweet_id", "parent_tweet_author_id")


@query("parse_v2_split")
def q_parse_v2_split(spark, sf):
    from tidepool.operators.parse import parse_tweet_v2, split_valid
    valid, _ = split_valid(parse_tweet_v2(_landed_json(spark, sf, 2)))
    return valid


@query("rejects")
def q_rejects(spark, sf):
    from tidepool.operators.parse import parse_tweet_v2, reject_reason
    p = parse_tweet_v2(_landed_json(spark, sf, 2))
    status = F.coalesce(reject_reason(p), F.lit("valid"))
    return p.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("media_best_variant")
def q_media_best_variant(spark, sf):
    from tidepool.operators.parse import extract_media
    return extract_media(_landed_json(spark, sf, 1))


@query("media_counts")
def q_media_counts(spark, sf):
    from tidepool.operators.parse import extract_media, route_media
    from tidepool.session import scratch_path
    path = scratch_path(spark, "media")
    route_media(extract_media(_landed_json(spark, sf, 1)), path, mode="overwrite")
    routed = spark.read.parquet(path)
    return routed.groupBy("table").agg(F.count(F.lit(1)).alias("n"))


@query("join_entities")
def q_join_entities(spark, sf):
    from tidepool.operators.parse import join_entities
    v2 = _landed_json(spark, sf, 2).where(F.col("data").isNotNull())
    urls, tags, ments = join_entities(F.col("data.entities"))
    return v2.select(F.col("data.id").alias("tweet_id"), urls.alias("expanded_urls"),
                     tags.alias("hashtags_str"), ments.alias("mentions_str"))


# --- landed files -----------------------------------------------------------

@query("articles_roundtrip")
def q_articles_roundtrip(spark, sf):
    from tidepool.session import scratch_path
    from tidepool.sources.files import read_articles, write_articles
    path = scratch_path(spark, "articles_csv")
    a = ad.articles_in(spark, sf).select("title", "content", "publishedAt", "url", "source")
    write_articles(a, path, fmt="csv", mode="overwrite")
    return read_articles(spark, path).select("source", "title", "content", "publishedAt", "url")


def _landed_ids(spark, sf) -> str:
    from tidepool.sources.files import write_id_files

    def write(path):
        t = ad.tweets(spark, sf, urls=False).select(
            "tweet_id", F.date_format("created_at", "yyyy-MM").alias("month"))
        write_id_files(t, path, mode="overwrite")
    return _landing(spark, "id_files", sf, write)


@query("id_files_month")
def q_id_files_month(spark, sf):
    from tidepool.sources.files import read_id_files
    return read_id_files(spark, _landed_ids(spark, sf))


@query("month_union")
def q_month_union(spark, sf):
    from tidepool.sources.files import month_ids
    return month_ids(spark, _landed_ids(spark, sf), "2024-01")


# --- page rules (tier b) and next links -------------------------------------

@query("page_rules")
def q_page_rules(spark, sf):
    from tidepool.operators.html_extract import extract_articles, rules_frame
    p = ad.table(spark, sf, "pages").withColumn("site", F.lit("generic"))
    ex = extract_articles(p, rules_frame(spark))
    return ex.select("page_id", "site", "title", "content", "next_href",
                     F.size("item_hrefs").alias("n_items"))


@query("listing_links")
def q_listing_links(spark, sf):
    """P13 tier (b): listing links by the site rule (generic rule: the
    navigation anchors), made absolute, distinct."""
    from tidepool.operators.html_extract import listing_links
    p = ad.table(spark, sf, "pages").withColumn("site", F.lit("generic"))
    return listing_links(p, None)


@query("next_link")
def q_next_link(spark, sf):
    from tidepool.operators.html_extract import next_link
    return next_link(ad.table(spark, sf, "pages"), "nav")


def _walk(spark, sf) -> tuple[DataFrame, DataFrame]:
    from tidepool.operators.html_extract import next_link
    from tidepool.operators.listing_walk import walk_pages
    p = ad.listing_pages(spark, sf)
    nexts = next_link(p, "aside").join(p.select("page_id", "url"), "page_id").select("url", "next_url")
    return p, walk_pages(nexts, ad.listing_starts(spark, sf))


@query("listing_walk")
def q_listing_walk(spark, sf):
    """P14 to its end: every page each walk meets, with its position."""
    return _walk(spark, sf)[1]


@query("listing_walk_links")
def q_listing_walk_links(spark, sf):
    """P13 + A12 along the walk: the distinct links of each walk and where
    each is met first."""
    from tidepool.operators.html_extract import ordered_links
    from tidepool.operators.listing_walk import walk_links
    p, walk = _walk(spark, sf)
    return walk_links(walk, ordered_links(p, "nav"))


# --- streaming (availableNow over the landed events file) -------------------

def _event_stream(spark, sf):
    from tidepool.streaming.jobs import parquet_stream
    return parquet_stream(spark, sf, "events.parquet")


def _post_rows(ev: DataFrame) -> DataFrame:
    """Events as posts: view -> retweet, error -> reply, others regular;
    the parent of a post is the event before it."""
    kind = F.when(F.col("event_type") == "view", "retweet").when(F.col("event_type") == "error", "reply") \
        .otherwise("regular")
    return ev.select(F.col("event_id").cast("string").alias("tweet_id"), kind.alias("kind"),
                     (F.col("event_id") - 1).cast("string").alias("parent_tweet_id"),
                     F.col("ts").alias("created_at"), "user_id", "value")


def _run(q):
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


@query("stream_ingest")
def q_stream_ingest(spark, sf):
    from tidepool.session import scratch_path
    from tidepool.streaming.jobs import stream_ingest
    out, ck = scratch_path(spark, "ingest"), scratch_path(spark, "ingest_ckpt")
    _run(stream_ingest(_post_rows(_event_stream(spark, sf)), out, ck))
    reg = spark.read.parquet(f"{out}/regular").select("tweet_id", F.lit("regular").alias("saved_to"))
    rts = spark.read.parquet(f"{out}/retweets").select("tweet_id", F.lit("retweets").alias("saved_to"))
    return reg.unionByName(rts)


@query("stream_dedup")
def q_stream_dedup(spark, sf):
    from tidepool.session import scratch_path
    from tidepool.streaming.jobs import stream_dedup
    out, ck = scratch_path(spark, "dedup"), scratch_path(spark, "dedup_ckpt")
    ev = _event_stream(spark, sf).select("user_id", "event_id", "ts")
    _run(stream_dedup(ev, "user_id", ["ts", "event_id"], out, ck))
    return spark.read.parquet(out).select("user_id", "event_id")


@query("stream_daily")
def q_stream_daily(spark, sf):
    from tidepool.session import scratch_path
    from tidepool.streaming.jobs import daily_counts
    out, ck = scratch_path(spark, "daily_counts"), scratch_path(spark, "daily_ckpt")
    _run(daily_counts(_event_stream(spark, sf), "ts", out, ck))
    return spark.read.parquet(out)


@query("stream_daily_closed")
def q_stream_daily_closed(spark, sf):
    """T4 in production form: a one-day watermark, append mode; only days
    the watermark has closed are written, once each."""
    from tidepool.functions.dates import ntz_as_utc
    from tidepool.session import scratch_path
    from tidepool.streaming.jobs import daily_counts
    out, ck = scratch_path(spark, "daily_closed"), scratch_path(spark, "daily_closed_ckpt")
    ev = _event_stream(spark, sf).withColumn("ts", ntz_as_utc("ts"))
    _run(daily_counts(ev, "ts", out, ck, watermark="1 day"))
    return spark.read.parquet(out).select("day", "n")


@query("stream_late_arrivals")
def q_stream_late_arrivals(spark, sf):
    """T3 on a stream (T2 with a delay): posts arrive in two deliveries to
    one folder - first the click/view/purchase feed, later the error and
    signup feed - and the job runs after each (resuming from its
    checkpoint). A 7-day watermark keeps a later post only if it is at most
    7 days older than the newest post already seen."""
    from tidepool.functions.dates import ntz_as_utc
    from tidepool.session import scratch_path
    from tidepool.streaming.jobs import stream_dedup
    ev = ad.table(spark, sf, "events")
    late = F.col("event_type").isin("error", "signup")
    src, out, ck = scratch_path(spark, "deliveries"), scratch_path(spark, "late"), scratch_path(spark, "late_ckpt")
    for delivery in (ev.where(~late), ev.where(late)):
        delivery.write.mode("append").parquet(src)
        rows = spark.readStream.schema(ev.schema).parquet(src).select("event_id", ntz_as_utc("ts").alias("ts"))
        _run(stream_dedup(rows, "event_id", ["ts", "event_id"], out, ck, delay="7 days", ts_col="ts"))
    return spark.read.parquet(out).select("event_id")


@query("stream_update")
def q_stream_update(spark, sf):
    from tidepool.session import scratch_path
    from tidepool.streaming.jobs import current_table, stream_update
    base, ck = scratch_path(spark, "balances"), scratch_path(spark, "balances_ckpt")
    ad.base_balances(spark, sf).write.mode("overwrite").parquet(f"{base}/v=00000000")
    upd = _event_stream(spark, sf).select(F.col("user_id").alias("key"), "value", "ts", "event_id")
    _run(stream_update(upd, base, "key", ["value"], ["ts", "event_id"], ck))
    return current_table(spark, base, "key")



@query("stream_json_ingest")
def q_stream_json_ingest(spark, sf):
    """S9 + P4 + F10 + T1: v2 JSON lines landed in a folder, read as a
    stream, classified, split into the two keyed tables."""
    from tidepool.session import scratch_path
    from tidepool.sources.tweets_json import stream_tweets
    from tidepool.streaming.jobs import classify_stream, stream_ingest
    src = _landing(spark, "json_stream", sf,
                   lambda path: ad.v2_json(spark, sf).select("value").write.mode("overwrite").text(path))
    out, ck = scratch_path(spark, "json_ingest"), scratch_path(spark, "json_ingest_ckpt")
    rows = classify_stream(stream_tweets(spark, src, version=2))
    _run(stream_ingest(rows, out, ck))
    reg = spark.read.parquet(f"{out}/regular").select("tweet_id", F.lit("regular").alias("saved_to"))
    rts = spark.read.parquet(f"{out}/retweets").select("tweet_id", F.lit("retweets").alias("saved_to"))
    return reg.unionByName(rts)


@query("stream_rejects")
def q_stream_rejects(spark, sf):
    """F10 on the stream: rows by status, counted while each epoch is stored."""
    from tidepool.session import scratch_path
    from tidepool.sources.tweets_json import stream_tweets
    from tidepool.streaming.jobs import status_counts, stream_split
    src = _landing(spark, "json_split", sf,
                   lambda path: ad.v2_json(spark, sf).select("value").write.mode("overwrite").text(path))
    out, ck = scratch_path(spark, "json_split_out"), scratch_path(spark, "json_split_ckpt")
    _run(stream_split(stream_tweets(spark, src, version=2), out, ck))
    return status_counts(spark, out)


@query("stream_closure")
def q_stream_closure(spark, sf):
    """T1 + J11: every conversation turn arrives on the stream; each
    micro-batch walks its chains against the archive and stores what the
    walk saves."""
    from tidepool.session import scratch_path
    from tidepool.streaming.jobs import parquet_stream, stream_ingest
    arch = ad.conversation_archive(spark, sf).withColumn("created_at", F.lit(None).cast("timestamp"))
    turns = parquet_stream(spark, sf, "conversations.parquet")
    seeds = turns.select((F.col("conv_id") * 100 + F.col("turn")).cast("string").alias("tweet_id"))
    out, ck = scratch_path(spark, "closure"), scratch_path(spark, "closure_ckpt")
    _run(stream_ingest(seeds, out, ck, archive=arch))
    reg = spark.read.parquet(f"{out}/regular").select("tweet_id", F.lit("regular").alias("saved_to"))
    rts = spark.read.parquet(f"{out}/retweets").select("tweet_id", F.lit("retweets").alias("saved_to"))
    return reg.unionByName(rts)


# --- chains kept up by a stream ----------------------------------------------

CHAIN_BUCKETS = 16


def _rooted(spark, sf) -> str:
    """Posts in two deliveries to one folder, replies to others' posts first
    and their parents later; the job runs after each."""
    from tidepool.session import scratch_path
    from tidepool.streaming.chains import stream_roots
    posts = ad.posts(spark, sf)
    late = F.col("tweet_id").cast("long") % 100 < 2
    src, out, ck = (scratch_path(spark, f"roots_{x}") for x in ("posts", "state", "ckpt"))
    for delivery in (posts.where(~late), posts.where(late)):
        delivery.write.mode("append").parquet(src)
        _run(stream_roots(spark.readStream.schema(posts.schema).parquet(src), out, ck, buckets=CHAIN_BUCKETS))
    return out


@query("stream_roots")
def q_stream_roots(spark, sf):
    """J5 by epoch: each reshare's root, kept up over two deliveries."""
    from tidepool.streaming.chains import current_roots
    return current_roots(spark, _rooted(spark, sf))


@query("stream_root_counts")
def q_stream_root_counts(spark, sf):
    """A6 by epoch: reshares per root from what each epoch added."""
    from tidepool.streaming.chains import current_root_counts
    return current_root_counts(spark, _rooted(spark, sf))


@query("indexed_closure")
def q_indexed_closure(spark, sf):
    """J11 over an edge index of the archive: a hop reads the buckets its
    frontier touches."""
    from tidepool.operators.edge_index import index_edges, saved_posts, walk_delivery
    from tidepool.session import scratch_path
    index, out = scratch_path(spark, "edge_index"), scratch_path(spark, "indexed_walk")
    index_edges(ad.conversation_archive(spark, sf), index, "archive", CHAIN_BUCKETS)
    walk_delivery(spark, index, out, "seeds", None, ad.conversation_seeds(spark, sf), CHAIN_BUCKETS)
    return saved_posts(spark, out)


@query("stream_walks")
def q_stream_walks(spark, sf):
    """T1 + J11 with parked walks: every turn arrives as a bare id while the
    archive lacks the first two turns of each conversation; the walks that
    stop there go on when the archive brings them."""
    from tidepool.operators.edge_index import index_edges, refresh_archive, saved_posts
    from tidepool.session import scratch_path
    from tidepool.streaming.chains import stream_walks
    from tidepool.streaming.jobs import parquet_stream
    arch = ad.conversation_archive(spark, sf)
    late = F.col("tweet_id").cast("long") % 100 < 2
    index, out, ck = (scratch_path(spark, f"walks_{x}") for x in ("index", "state", "ckpt"))
    index_edges(arch.where(~late), index, "archive-0", CHAIN_BUCKETS)
    turns = parquet_stream(spark, sf, "conversations.parquet")
    seeds = turns.select((F.col("conv_id") * 100 + F.col("turn")).cast("string").alias("tweet_id"))
    _run(stream_walks(seeds, index, out, ck, CHAIN_BUCKETS))
    refresh_archive(arch.where(late), index, out, "archive-1", CHAIN_BUCKETS)
    return saved_posts(spark, out)


@query("stream_first_links")
def q_stream_first_links(spark, sf):
    """T2 by key filters: pages arrive in three deliveries; each link is kept with
    the page that held it first (of a delivery, the lowest page)."""
    from tidepool.operators.html_extract import extract_links
    from tidepool.operators.key_filter import stored_rows
    from tidepool.session import scratch_path
    from tidepool.streaming.jobs import stream_first_seen
    pages = ad.table(spark, sf, "pages").select("page_id", "url", "html")
    src, out, ck = (scratch_path(spark, f"links_{x}") for x in ("pages", "seen", "ckpt"))
    for delivery in (0, 1, 2):
        pages.where(F.pmod("page_id", F.lit(3)) == delivery).write.mode("append").parquet(src)
        found = extract_links(spark.readStream.schema(pages.schema).parquet(src))
        _run(stream_first_seen(found.select("link", "page_id"), "link", ["page_id"], out, ck, buckets=CHAIN_BUCKETS))
    return stored_rows(spark, out, "link string, page_id long")
