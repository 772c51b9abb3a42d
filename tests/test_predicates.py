import pytest

from tidepool.operators.predicates import (any_term, has_all_tags, has_links, match_rules, non_replies,
                                           not_retweet, only_retweets, select_where, union_distinct)
from tidepool.operators.stats import top_items, top_tags
from tidepool.functions.text import split_entities


@pytest.fixture(scope="module")
def posts(spark):
    rows = [("1", "#Covid19,#2020Election", "http://a", "en", "regular", "Stay Safe"),
            ("2", "#2020election", "", "en", "regular", "vote now"),
            ("3", "#2020ELECTION", "http://b", "en", "retweet", "RT vote"),
            ("4", "#2020election", "http://c", "fr", "regular", "voter"),
            ("5", "#2020election", "http://d", "en", "reply", "a.b (c)")]
    return spark.createDataFrame(rows, "tweet_id string, hashtags_str string, expanded_urls string, "
                                       "lang string, kind string, text string")


def ids(df):
    return sorted(r.tweet_id for r in df.collect())


def test_rules_or_of_ands(posts):
    rules = ["#covid19 #2020election", "#2020election has:links lang:en -is:retweet"]
    assert ids(match_rules(posts, rules)) == ["1", "5"]
    assert ids(match_rules(posts, ["#2020election is:retweet"])) == ["3"]
    with pytest.raises(ValueError):
        match_rules(posts, ["from:someone"])


def test_single_filters(posts):
    assert ids(has_all_tags(posts, ["#2020Election"])) == ["1", "2", "3", "4", "5"]
    assert ids(has_links(posts)) == ["1", "3", "4", "5"]
    assert ids(not_retweet(posts)) == ["1", "2", "4", "5"]
    assert ids(only_retweets(posts)) == ["3"]
    assert ids(non_replies(posts)) == ["1", "2", "3", "4"]
    assert ids(select_where(posts, ["tweet_id"], "lang = 'fr'")) == ["4"]


def test_any_term_escapes_and_ignores_case(posts):
    assert ids(any_term(posts, "text", ["SAFE", "a.b (c"])) == ["1", "5"]
    assert ids(any_term(posts, "text", ["."])) == ["5"]


def test_union_distinct_and_tags(posts):
    u = union_distinct([posts.where("lang = 'en'").select("tweet_id"), posts.where("kind = 'regular'").select("tweet_id")])
    assert ids(u) == ["1", "2", "3", "4", "5"]
    top = [tuple(r) for r in top_tags(posts, "hashtags_str", 1).collect()]
    assert top == [("#2020election", 5)]
    ties = [tuple(r) for r in top_items(posts, split_entities("hashtags_str"), 2).collect()]
    assert ties == [("#2020election", 5), ("#covid19", 1)]


def test_top_sites_and_write_append(spark, tmp_path):
    from tidepool.operators.keyed import write_append
    from tidepool.operators.stats import top_sites
    df = spark.createDataFrame([("1", "https://A.com/x,http://b.org/y?q"), ("2", "HTTPS://A.com/z,noscheme"),
                                ("3", "")], "tweet_id string, expanded_urls string")
    got = [tuple(r) for r in top_sites(df, "expanded_urls", 5).collect()]
    assert got == [("https://A.com/", 2), ("http://b.org/", 1)]
    out = str(tmp_path / "t")
    write_append(df, out)
    write_append(df, out)
    assert spark.read.parquet(out).count() == 6
    write_append(df, out, mode="overwrite")
    assert spark.read.parquet(out).count() == 3
