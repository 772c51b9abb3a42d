"""Tweet JSON -> flat rows.

Nested fields are read with struct access and higher-order array
functions (``filter``/``transform``/``array_max``): no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Reference types decide the v2 kind (first match wins; a
# quote is passed over), media type -> table.
DECISIVE_REF_TYPES = ["retweeted", "replied_to"]
MEDIA_TABLES = {"photo": "images", "video": "videos", "animated_gif": "gifs", "other": "externals"}
# ---------------------------------------------------------------------------


def _joined(arr: Column, field: str, prefix: str) -> Column:
    items = F.transform(arr, lambda x: F.concat(F.lit(prefix), x[field]))
    return F.coalesce(F.array_join(items, ","), F.lit(""))


def parse_tweet_v1(df: DataFrame, extended: bool = False) -> DataFrame:
    """Hydrated-tweet row. Extended mode keeps ``full_text`` sliced to
    ``display_text_range`` (half-open); otherwise all of ``text``."""
    if extended:
        r0 = F.get(F.col("display_text_range"), 0)
        r1 = F.get(F.col("display_text_range"), 1)
        text = F.col("full_text").substr(r0 + 1, r1 - r0)
    else:
        text = F.col("text")
    return df.select(
        F.col("id_str").alias("tweet_id"),
        text.alias("full_text"),
        F.col("created_at"),
        F.col("lang").alias("language"),
        _joined(F.col("entities.hashtags"), "text", "#").alias("hashtags_str"),
        _joined(F.col("entities.user_mentions"), "screen_name", "@").alias("mentions_str"),
        F.col("favorite_count"),
        F.col("retweet_count"),
    )


def best_variant_url(variants: Column) -> Column:
    """URL of the variant with the greatest bitrate; variants lacking a
    bitrate are ignored; on a tie the later one wins (stable sort, take
    last)."""
    ranked = F.transform(F.filter(variants, lambda v: v["bitrate"].isNotNull()),
                         lambda v, i: F.struct(v["bitrate"].alias("b"), i.alias("i"), v["url"].alias("url")))
    return F.array_max(ranked)["url"]


def media_items(media: Column, urls: Column) -> Column:
    """array<struct<media_type, media_url>>: photos give ``media_url``,
    every other type its best variant; without a media list, each linked
    URL is an ``other`` item."""
    from_media = F.transform(media, lambda m: F.struct(
        m["type"].alias("media_type"),
        F.when(m["type"] == "photo", m["media_url"])
         .otherwise(best_variant_url(m["video_info"]["variants"])).alias("media_url")))
    from_urls = F.transform(urls, lambda u: F.struct(F.lit("other").alias("media_type"),
                                                     u["expanded_url"].alias("media_url")))
    return F.when(media.isNotNull(), from_media).otherwise(from_urls)


def extract_media(df: DataFrame) -> DataFrame:
    """``(tweet_id, media_type, media_url)``; a video with no usable
    variant yields no row (its tweet is still parsed, D13)."""
    items = media_items(F.col("extended_entities.media"), F.col("entities.urls"))
    ex = df.select(F.col("id_str").alias("tweet_id"), F.explode(items).alias("m"))
    return ex.select("tweet_id", "m.media_type", "m.media_url").where(F.col("media_url").isNotNull())


def route_media(media: DataFrame, path: str, mode: str = "append") -> None:
    """one write, partitioned by target table (images/videos/gifs/
    externals) instead of four filtered passes. Rows are keyed by table,
    ``tweet_id`` and ``media_url``: repeats, and on append keys already
    stored, are left out."""
    table = F.lit(None).cast("string")
    for t, name in MEDIA_TABLES.items():
        table = F.when(F.col("media_type") == t, F.lit(name)).otherwise(table)
    out = media.withColumn("table", F.coalesce(table, F.lit("externals")))
    out = out.dropDuplicates(["table", "tweet_id", "media_url"])
    if mode == "append":
        from tidepool.streaming.jobs import _exists
        spark = media.sparkSession
        if _exists(spark, path):
            keys = ["table", "tweet_id", "media_url"]
            out = out.join(spark.read.parquet(path).select(*keys), keys, "left_anti")
    out.write.mode(mode).partitionBy("table").parquet(path)


def parse_retweet_v1(df: DataFrame) -> DataFrame:
    """Retweet row from a v1.1 object; parent fields are '' when the
    tweet is not a retweet. ``retweet_count`` is read from its own field
    (the reference read ``reply_count`` there, D3)."""
    rs = F.col("retweeted_status")
    return df.select(
        rs.isNotNull().alias("is_retweet"),
        F.col("id_str").alias("tweet_id"),
        F.col("user.id_str").alias("author_id"),
        "created_at",
        F.coalesce(rs["id_str"], F.lit("")).alias("parent_tweet_id"),
        F.coalesce(rs["user"]["id_str"], F.lit("")).alias("parent_tweet_author_id"),
        F.col("favorite_count").alias("like_count"),
        "quote_count", "reply_count", "retweet_count",
        "text",
    )


def join_entities(entities: Column) -> tuple[Column, Column, Column]:
    """P5: (urls, hashtags, mentions) as comma text: all expanded URLs then
    all unwound URLs; ``#tag``; ``@username``."""
    urls = entities["urls"]
    exp = F.transform(F.filter(urls, lambda u: u["expanded_url"].isNotNull()), lambda u: u["expanded_url"])
    unw = F.transform(F.filter(urls, lambda u: u["unwound_url"].isNotNull()), lambda u: u["unwound_url"])
    url_s = F.coalesce(F.array_join(F.concat(exp, unw), ","), F.lit(""))
    return (url_s, _joined(entities["hashtags"], "tag", "#"),
            _joined(entities["mentions"], "username", "@"))


def parse_tweet_v2(df: DataFrame) -> DataFrame:
    """P4 + J6: classify by the first ``retweeted``/``replied_to`` reference
    and flatten to one union schema with ``kind`` in
    {retweet, reply, regular}. The parent's author comes from
    ``includes.tweets`` (NULL when absent, which F10 rejects)."""
    d = F.col("data")
    ref = F.get(F.filter(d["referenced_tweets"], lambda r: r["type"].isin(DECISIVE_REF_TYPES)), 0)
    kind = (F.when(ref["type"] == "retweeted", "retweet")
            .when(ref["type"] == "replied_to", "reply").otherwise("regular"))
    parent_author = F.get(F.filter(F.col("includes.tweets"), lambda t: t["id"] == ref["id"]), 0)["author_id"]
    url_s, tag_s, men_s = join_entities(d["entities"])
    regular = kind == "regular"
    m = d["public_metrics"]
    return df.select(
        d["id"].alias("tweet_id"),
        kind.alias("kind"),
        d["author_id"].alias("author_id"),
        d["created_at"].alias("created_at"),
        d["text"].alias("text"),
        F.when(~regular, ref["id"]).alias("parent_tweet_id"),
        F.when(kind == "retweet", parent_author).alias("parent_tweet_author_id"),
        F.when(regular, url_s).alias("expanded_urls"),
        F.when(regular, tag_s).alias("hashtags_str"),
        F.when(regular, men_s).alias("mentions_str"),
        m["like_count"].alias("like_count"), m["quote_count"].alias("quote_count"),
        m["reply_count"].alias("reply_count"), m["retweet_count"].alias("retweet_count"),
        F.col("_corrupt_record"),
    )


# what ``reject_reason`` can say
REJECT_REASONS = ("malformed", "no id", "no author", "no text", "no time", "no metrics", "parent not included")


def reject_reason(parsed: DataFrame) -> Column:
    """Why a parsed v2 row is unusable, NULL when it is fine."""
    return (F.when(F.col("_corrupt_record").isNotNull(), "malformed")
            .when(F.col("tweet_id").isNull(), "no id")
            .when(F.col("author_id").isNull(), "no author")
            .when(F.col("text").isNull(), "no text")
            .when(F.col("created_at").isNull(), "no time")
            .when(F.col("like_count").isNull() | F.col("quote_count").isNull() | F.col("reply_count").isNull()
                  | F.col("retweet_count").isNull(), "no metrics")
            .when((F.col("kind") == "retweet") & F.col("parent_tweet_author_id").isNull(),
                  "parent not included"))


def reject_reason_v1(raw: DataFrame, extended: bool = False) -> Column:
    """Why a v1.1 object lacks what P1 and P3 read, NULL when it is fine."""
    text = "full_text" if extended else "text"
    reason = (F.when(F.col("_corrupt_record").isNotNull(), "malformed")
              .when(F.col("id_str").isNull(), "no id")
              .when(F.col("user.id_str").isNull(), "no author")
              .when(F.col(text).isNull(), "no text")
              .when(F.col("created_at").isNull(), "no time"))
    return reason.when(F.size("display_text_range") != 2, "no text range") if extended else reason


def split_valid_v1(raw: DataFrame, extended: bool = False) -> tuple[DataFrame, DataFrame]:
    """F10 for v1.1: (objects that P1 and P3 can read, rejects with a reason)."""
    tagged = raw.withColumn("reject_reason", reject_reason_v1(raw, extended))
    return (tagged.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.where(F.col("reject_reason").isNotNull()))


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects with a reason)."""
    tagged = parsed.withColumn("reject_reason", reject_reason(parsed))
    valid = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason", "_corrupt_record")
    rejects = tagged.where(F.col("reject_reason").isNotNull())
    return valid, rejects
