import random
import string

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import one_col
from tidepool.functions.text import STOPWORDS_EN, clean_text, split_entities, tokens

KEPT = set(string.ascii_letters + string.digits + " \t")


def _is_word(ch):
    return ch.isalnum() or ch == "_"


def brute_clean(text):
    """Scan left to right: a character outside the kept set is dropped; a
    URL (word characters, '://', non-blank run) starting at a kept
    character is dropped whole; blank runs become one space."""
    s, out, i = text.lower(), [], 0
    while i < len(s):
        ch = s[i]
        if ch not in KEPT:
            i += 1
            continue
        j = i
        while j < len(s) and _is_word(s[j]):
            j += 1
        if j > i and s.startswith("://", j) and j + 3 < len(s) and not s[j + 3].isspace():
            k = j + 3
            while k < len(s) and not s[k].isspace():
                k += 1
            i = k
            continue
        out.append(ch)
        i += 1
    return " ".join("".join(out).split())


def run(spark, fn, values):
    df = one_col(spark, values)
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_clean_fixture_rows(spark):
    got = run(spark, clean_text, ["a\nb http://x.y/z?q #Tag @me don't covid-19",
                                  "hétp://q w", "(https://a.b) &amp; x", None, ""])
    assert got == ["ab tag me dont covid19", "w", "amp x", None, ""]


def test_clean_matches_brute_force_on_urls(spark):
    rnd = random.Random(7)
    alphabet = list("abcXYZ019 \t\n_:/.-é,#@ü") + ["://", "http://", "ws://", "é://"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(400)]
    assert run(spark, clean_text, texts) == [brute_clean(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab9 Z\t\n:/_é.")), max_size=25), min_size=1, max_size=8))
def test_clean_is_idempotent_and_brute(spark, texts):
    once = run(spark, clean_text, texts)
    assert once == [brute_clean(t) for t in texts]
    assert run(spark, clean_text, once) == once


def test_tokens_fixture(spark):
    got = run(spark, tokens, ["covid19 b2b 19abc the"])
    assert got == [["covid", "19", "b2b", "19abc"]]


def test_tokens_phone_and_emoticon_rules(spark):
    got = run(spark, tokens, ["Call 555 1234 now, 8days dog d8 1-800-555-1234x"])
    assert got == [["call", "555 1234", "8d", "ays", "dog", "d8", "18005551234", "x"]]


def test_tokens_drop_stopwords_case_blind(spark):
    got = run(spark, tokens, ["The THE theory of Them abc12"])
    assert got == [["theory", "abc", "12"]]
    assert "the" in STOPWORDS_EN and len(STOPWORDS_EN) == 179


def test_split_entities(spark):
    got = run(spark, split_entities, ["#A,,#b", "", None])
    assert got == [["#a", "#b"], [], []]
    urls = run(spark, lambda c: split_entities(c, lower=False), ["HTTP://A.b/X,"])
    assert urls == [["HTTP://A.b/X"]]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.text(alphabet=st.sampled_from(list("abcXYZ19_é")), min_size=1, max_size=6),
                         max_size=5), min_size=1, max_size=5))
def test_join_then_split_round_trips(spark, lists):
    from tidepool.functions.text import join_list
    df = spark.createDataFrame([(x,) for x in lists], "v array<string>")
    got = [r[0] for r in df.select(split_entities(join_list(F.col("v"), "#"), lower=False)).collect()]
    assert got == [["#" + t for t in x] for x in lists]


def test_tokens_squeeze_blank_runs_first(spark):
    got = spark.createDataFrame([("123  4567 123\t4567 end",)], "t string").select(tokens("t", []).alias("x")).first().x
    one = spark.createDataFrame([("123 4567 123 4567 end",)], "t string").select(tokens("t", []).alias("x")).first().x
    assert got == one
