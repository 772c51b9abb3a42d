"""Declared schemas: the stored tables and the two tweet JSON shapes.

Raw JSON is always read with an explicit schema (no inference pass over
100 TB); only the fields the parsers use are declared, the rest are
skipped by the JSON reader.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, IntegerType, LongType, StringType, StructField,
                               StructType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


S, L, I = StringType(), LongType(), IntegerType()

# v1.1 tweet object (fields read by the parsers)
TWEET_V1 = _s(
    ("id_str", S), ("text", S), ("full_text", S), ("display_text_range", ArrayType(I)),
    ("created_at", S), ("lang", S),
    ("favorite_count", L), ("retweet_count", L), ("quote_count", L), ("reply_count", L),
    ("user", _s(("id_str", S))),
    ("entities", _s(
        ("hashtags", ArrayType(_s(("text", S)))),
        ("user_mentions", ArrayType(_s(("screen_name", S)))),
        ("urls", ArrayType(_s(("expanded_url", S)))))),
    ("extended_entities", _s(("media", ArrayType(_s(
        ("type", S), ("media_url", S),
        ("video_info", _s(("variants", ArrayType(_s(("bitrate", L), ("url", S))))))))))),
    ("retweeted_status", _s(("id_str", S), ("user", _s(("id_str", S))))),
    ("_corrupt_record", S),
)

# v2 tweet envelope
TWEET_V2 = _s(
    ("data", _s(
        ("id", S), ("author_id", S), ("created_at", S), ("text", S),
        ("public_metrics", _s(("like_count", L), ("quote_count", L), ("reply_count", L),
                              ("retweet_count", L))),
        ("referenced_tweets", ArrayType(_s(("type", S), ("id", S)))),
        ("entities", _s(
            ("urls", ArrayType(_s(("expanded_url", S), ("unwound_url", S)))),
            ("hashtags", ArrayType(_s(("tag", S)))),
            ("mentions", ArrayType(_s(("username", S)))))))),
    ("includes", _s(("tweets", ArrayType(_s(("id", S), ("author_id", S)))))),
    ("_corrupt_record", S),
)

# stored tables (reference column lists; keys noted)
REGULAR_TWEETS = _s(  # key tweet_id
    ("tweet_id", S), ("author_id", S), ("created_at", S), ("text", S), ("expanded_urls", S),
    ("hashtags_str", S), ("mentions_str", S), ("like_count", L), ("quote_count", L),
    ("reply_count", L), ("retweet_count", L))
RETWEETS = _s(  # key tweet_id
    ("tweet_id", S), ("author_id", S), ("created_at", S), ("parent_tweet_id", S),
    ("parent_tweet_author_id", S), ("like_count", L), ("quote_count", L), ("reply_count", L),
    ("retweet_count", L), ("text", S))
HYDRATED_TWEETS = _s(  # key tweet_id
    ("tweet_id", S), ("full_text", S), ("created_at", S), ("language", S), ("hashtags_str", S),
    ("mentions_str", S), ("favorite_count", L), ("retweet_count", L))
MEDIA = _s(("tweet_id", S), ("media_url", S))  # key (tweet_id, media_url)
ARTICLES = _s(  # key article_id; url unique by the loader
    ("article_id", L), ("title", S), ("source", S), ("content", S), ("publishedAt", S),
    ("url", S), ("label", S))
ARTICLE_CSV = _s(("title", S), ("content", S), ("publishedAt", S), ("url", S))

NOT_NULL = {
    "regular_tweets": ["author_id", "created_at", "text"],
    "retweets": ["author_id", "created_at", "parent_tweet_id", "parent_tweet_author_id"],
    "hydrated": ["full_text", "created_at"],
    "articles": ["title", "source", "content", "url"],
}
