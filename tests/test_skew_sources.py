import os
import tempfile

import pytest

from tidepool.operators.keyed import assign_ids
from tidepool.operators.skew import hot_keys, lookup_join
from tidepool.sources.files import read_articles, read_daily_tsv, read_id_files, write_articles


@pytest.fixture(scope="module")
def frames(spark):
    probe = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}") for i in range(300)] + [(999, None)],
                                  "id int, k string")
    look = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "lk string, v int")
    return probe, look


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_equals_plain_join(frames, how):
    probe, look = frames
    plain = probe.join(look, probe.k == look.lk, how)
    split = lookup_join(probe, "k", look, "lk", how=how, hot_rows=50, max_hot=5)
    cols = plain.columns
    assert sorted(map(tuple, split.select(*cols).collect()), key=str) == \
        sorted(map(tuple, plain.collect()), key=str)


def test_hot_keys_bounded(frames):
    probe, _ = frames
    assert [r[0] for r in hot_keys(probe, "k", 50, 5).collect()] == ["hot"]
    assert hot_keys(probe, "k", 1, 2).count() == 2


def test_assign_ids_with_empty_partitions(spark):
    df = spark.createDataFrame([(i * 1000,) for i in range(5)], "o long")
    got = sorted((r.o, r.article_id) for r in assign_ids(df, 10, ["o"], num_partitions=20).collect())
    assert got == [(i * 1000, 10 + i) for i in range(5)]


def test_read_articles_source_from_file_name(spark):
    d = tempfile.mkdtemp(prefix="tidepool-csv-")
    with open(os.path.join(d, "WND.csv"), "w") as f:
        f.write('title,content,publishedAt,url\n"A ""q""","line1\nline2",'
                '"March 25, 2020 at 1:40pm",http://w/1\nB,,,http://w/2\n')
    rows = {r.url: r for r in read_articles(spark, d).collect()}
    assert rows["http://w/1"].source == "WND"
    assert rows["http://w/1"].title == 'A "q"' and rows["http://w/1"].content == "line1\nline2"
    assert rows["http://w/2"].content is None
    out = tempfile.mkdtemp(prefix="tidepool-csv-out-") + "/a"
    write_articles(read_articles(spark, d), out, fmt="csv", mode="overwrite")
    back = {r.url: (r.source, r.content) for r in read_articles(spark, out).collect()}
    assert back["http://w/1"] == ("WND", "line1\nline2")


def test_id_files_and_daily_tsv(spark):
    d = tempfile.mkdtemp(prefix="tidepool-ids-")
    os.makedirs(f"{d}/2020-03")
    with open(f"{d}/2020-03/a.txt", "w") as f:
        f.write(" 1 \n\n2\n")
    got = sorted(tuple(r) for r in read_id_files(spark, d).collect())
    assert got == [("2020-03", "1"), ("2020-03", "2")]
    t = tempfile.mkdtemp(prefix="tidepool-tsv-")
    for name, rows in [("2020-03-01.tsv", ["1\ten", "2\tfr"]), ("2020-03-01_clean.tsv", ["1\ten"])]:
        with open(f"{t}/{name}", "w") as f:
            f.write("tweet_id\tlang\n" + "\n".join(rows) + "\n")
    v = sorted((r.variant, r.tweet_id) for r in read_daily_tsv(spark, t).collect())
    assert v == [("clean", "1"), ("full", "1"), ("full", "2")]


def test_text_tables_are_spread_only_where_the_caller_asks(spark, tmp_path):
    from tidepool.plans.adapters import spread_coarse_input
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/one")

    def shuffles():
        df = spread_coarse_input(spark.read.parquet(f"{tmp_path}/one"))
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange")
    assert shuffles() == 0
    spark.conf.set("spark.tidepool.textPartitions", "6")
    try:
        assert shuffles() == 1
    finally:
        spark.conf.unset("spark.tidepool.textPartitions")


def test_daily_tsv_columns_by_name(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("tweet_id\tdate\tlang\n1\t2020-03-01\ten\n2\t\tfr\n")
    (tmp_path / "a_clean.tsv").write_text("lang\ttweet_id\nen\t1\n")
    got = sorted((r.variant, r.tweet_id, r.lang, r.date) for r in read_daily_tsv(spark, str(tmp_path)).collect())
    assert got == [("clean", "1", "en", None), ("full", "1", "en", "2020-03-01"), ("full", "2", "fr", None)]


def test_a_row_like_a_header_is_a_row(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("\ntweet_id\tlang\tday\n1\ten\tx\nlang\ttweet_id\tday\n")
    (tmp_path / "b.tsv").write_text("lang\ttweet_id\n")  # no rows
    (tmp_path / "c.tsv").write_text("")
    got = sorted((r.tweet_id, r.lang, r.day) for r in read_daily_tsv(spark, str(tmp_path)).collect())
    assert got == [("1", "en", "x"), ("lang", "tweet_id", "day")]
    named = read_daily_tsv(spark, str(tmp_path), ["day", "tweet_id", "absent"])
    assert named.columns == ["day", "tweet_id", "absent", "variant"]
    assert sorted((r.tweet_id, r.day, r.absent) for r in named.collect()) == [("1", "x", None), ("lang", "day", None)]
