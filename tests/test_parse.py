import json


from tidepool.operators.parse import (extract_media, parse_retweet_v1, parse_tweet_v1, parse_tweet_v2,
                                      split_valid)
from tidepool.sources.tweets_json import parse_json_column


def v1(spark, objs):
    df = spark.createDataFrame([(json.dumps(o),) for o in objs], "value string")
    return parse_json_column(df, "value", version=1)


def v2(spark, objs):
    df = spark.createDataFrame([(o if isinstance(o, str) else json.dumps(o),) for o in objs], "value string")
    return parse_json_column(df, "value", version=2)


def test_best_variant_tie_and_missing_bitrate(spark):
    video = {"id_str": "1", "extended_entities": {"media": [{"type": "video", "video_info": {"variants": [
        {"bitrate": 1, "url": "a"}, {"url": "none"}, {"bitrate": 9, "url": "b"}, {"bitrate": 9, "url": "c"}]}}]}}
    no_rate = {"id_str": "2", "extended_entities": {"media": [{"type": "animated_gif", "video_info": {
        "variants": [{"url": "x"}]}}]}}
    photo = {"id_str": "3", "extended_entities": {"media": [{"type": "photo", "media_url": "p"}]}}
    links = {"id_str": "4", "entities": {"urls": [{"expanded_url": "u1"}, {"expanded_url": "u2"}]}}
    rows = sorted(tuple(r) for r in extract_media(v1(spark, [video, no_rate, photo, links])).collect())
    assert rows == [("1", "video", "c"), ("3", "photo", "p"), ("4", "other", "u1"), ("4", "other", "u2")]


def test_parse_v1_extended_slice(spark):
    o = {"id_str": "9", "full_text": "@a hello there", "text": "x", "display_text_range": [3, 8],
         "entities": {"hashtags": [{"text": "A"}, {"text": "b"}], "user_mentions": [{"screen_name": "m"}]},
         "favorite_count": 2, "retweet_count": 3, "lang": "en", "created_at": "Wed Oct 10 20:19:24 +0000 2018"}
    r = parse_tweet_v1(v1(spark, [o]), extended=True).collect()[0]
    assert (r.full_text, r.hashtags_str, r.mentions_str) == ("hello", "#A,#b", "@m")
    r2 = parse_tweet_v1(v1(spark, [o]), extended=False).collect()[0]
    assert r2.full_text == "x"


def test_retweet_v1_counts_own_field(spark):
    o = {"id_str": "5", "user": {"id_str": "u"}, "reply_count": 3, "retweet_count": 5,
         "retweeted_status": {"id_str": "4", "user": {"id_str": "w"}}}
    plain = {"id_str": "6", "user": {"id_str": "u"}}
    rows = {r.tweet_id: r for r in parse_retweet_v1(v1(spark, [o, plain])).collect()}
    assert rows["5"].retweet_count == 5 and rows["5"].is_retweet
    assert (rows["6"].parent_tweet_id, rows["6"].parent_tweet_author_id, rows["6"].is_retweet) == ("", "", False)


def test_v2_classification(spark):
    base = {"id": "1", "author_id": "a", "created_at": "t", "text": "x",
            "public_metrics": {"like_count": 1, "quote_count": 0, "reply_count": 0, "retweet_count": 0}}
    reply = {"data": dict(base, id="r", referenced_tweets=[{"type": "quoted", "id": "q"},
                                                           {"type": "replied_to", "id": "p"}])}
    quote = {"data": dict(base, id="q", referenced_tweets=[{"type": "quoted", "id": "z"}],
                          entities={"urls": [{"expanded_url": "a", "unwound_url": "u"}, {"expanded_url": "b"}]})}
    rt_ok = {"data": dict(base, id="t", referenced_tweets=[{"type": "retweeted", "id": "p"}]),
             "includes": {"tweets": [{"id": "z", "author_id": "no"}, {"id": "p", "author_id": "pa"}]}}
    rt_bad = {"data": dict(base, id="s", referenced_tweets=[{"type": "retweeted", "id": "p"}])}
    cut = json.dumps(reply)[:30]
    parsed = parse_tweet_v2(v2(spark, [reply, quote, rt_ok, rt_bad, cut]))
    valid, rejects = split_valid(parsed)
    got = {r.tweet_id: r for r in valid.collect()}
    assert got["r"].kind == "reply" and got["r"].parent_tweet_id == "p"
    assert got["q"].kind == "regular" and got["q"].expanded_urls == "a,b,u"
    assert got["t"].kind == "retweet" and got["t"].parent_tweet_author_id == "pa"
    reasons = sorted(r.reject_reason for r in rejects.collect())
    assert reasons == ["malformed", "parent not included"]


def test_route_media_partitions_by_table(spark, tmp_path):
    from tidepool.operators.parse import route_media
    media = spark.createDataFrame([("1", "photo", "p"), ("2", "video", "v"), ("3", "animated_gif", "g"),
                                   ("4", "other", "o")], "tweet_id string, media_type string, media_url string")
    out = str(tmp_path / "media")
    route_media(media, out, mode="overwrite")
    import os
    assert sorted(d for d in os.listdir(out) if d.startswith("table=")) == [
        "table=externals", "table=gifs", "table=images", "table=videos"]
    back = spark.read.parquet(out).where("table = 'images'").collect()
    assert [(r.tweet_id, r.media_url) for r in back] == [("1", "p")]


def test_cli_lists_queries(capsys):
    from tidepool.__main__ import main
    assert main(["list"]) == 0
    names = capsys.readouterr().out.split()
    assert "topk_words" in names and "word_top20" in names


def test_required_fields_are_rejected_with_a_reason(spark):
    from tidepool.operators.parse import reject_reason, reject_reason_v1
    m = {"like_count": 0, "quote_count": 0, "reply_count": 0, "retweet_count": 0}
    full = {"id": "1", "author_id": "a", "text": "t", "created_at": "2024-01-01T00:00:00.000Z", "public_metrics": m}
    objs = [{"data": full}] + [{"data": {k: v for k, v in full.items() if k != gone}} for gone in full] + ["{broken"]
    p = parse_tweet_v2(v2(spark, objs))
    got = sorted(r[0] or "valid" for r in p.select(reject_reason(p)).collect())
    assert got == sorted(["valid", "no id", "no author", "no text", "no time", "no metrics", "malformed"])
    one = {"id_str": "1", "text": "t", "created_at": "Wed Jan 01 00:00:00 +0000 2020", "user": {"id_str": "u"}}
    raw = v1(spark, [one] + [{k: v for k, v in one.items() if k != gone} for gone in one])
    got = sorted(r[0] or "valid" for r in raw.select(reject_reason_v1(raw)).collect())
    assert got == sorted(["valid", "no id", "no author", "no text", "no time"])


def test_media_is_keyed_by_tweet_and_url(spark, tmp_path):
    from tidepool.operators.parse import route_media
    media = spark.createDataFrame([("1", "photo", "a"), ("1", "photo", "a"), ("1", "video", "b")], "tweet_id string, media_type string, media_url string")
    route_media(media, f"{tmp_path}/m")
    route_media(media, f"{tmp_path}/m")  # the same rows again
    assert sorted(r["table"] for r in spark.read.parquet(f"{tmp_path}/m").collect()) == ["images", "videos"]
