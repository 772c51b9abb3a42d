import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidepool.llm import textkernel as tk

WORD = re.compile("[0-9a-z\u00c0-\u1fff\u2080-\u2fff\u3040-\U0010ffff]+")
TEXT = st.text(alphabet=st.sampled_from("abzAZ09 .,-\n\t!éÉñß\u00a0\u00bf\u2013\u2019\u3001日本ΩЖ"), max_size=60)


def words(text):
    return WORD.findall(pa.compute.utf8_lower(pa.scalar(text)).as_py())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=12))
def test_word_hashes_follow_the_pattern(texts):
    got = []
    for _, _, h, off in tk.word_slices(pa.array(texts, pa.string()), limit=64):
        got += [h[a:b].tolist() for a, b in zip(off, off[1:])]
    assert [len(g) for g in got] == [len(words(t or "")) for t in texts]
    names, back = {}, {}
    for t, g in zip(texts, got):
        for w, h in zip(words(t or ""), g):
            assert names.setdefault(w, h) == h and back.setdefault(h, w) == w


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, max_size=8), st.integers(1, 5))
def test_shingles_match_brute_force(texts, k):
    got = []
    for _, _, h, off in tk.word_slices(pa.array(texts, pa.string())):
        s, soff = tk.shingles(h, off, k)
        got += [s[a:b].tolist() for a, b in zip(soff, soff[1:])]
    seen, back = {}, {}
    for t, g in zip(texts, got):
        w = words(t)
        want = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)] * bool(w)
        assert len(want) == len(g)
        for x, h in zip(want, g):
            assert seen.setdefault(x, h) == h and back.setdefault(h, x) == x


def test_very_long_text_is_read_whole():
    text = " ".join(f"w{i}" for i in range(3000))
    whole = next(tk.word_slices(pa.array([text])))[2]
    cut = next(tk.word_slices(pa.array([text]), limit=100))[2]
    assert len(whole) == 3000 and (whole == cut).all()
    assert len(next(tk.word_slices(pa.array(["x" * 1000 + " y"]), limit=100))[2]) == 2  # an endless word is one word


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab,。、—日本語é ’Ω 1"), min_size=30, max_size=400), st.integers(3, 64))
def test_long_texts_are_cut_between_words(text, limit):
    whole = next(tk.word_slices(pa.array([text])))[2]
    cut = next(tk.word_slices(pa.array([text]), limit=limit))[2]
    assert len(whole) == len(words(text)) and (whole == cut).all()


def test_long_texts_without_blanks():
    for text in ("日本語、" * 120_000, "abcde," * 140_000, "漢" * 400_000 + "。字", "é—" * 200_000):
        got = next(tk.word_slices(pa.array([text])))[2]
        assert len(got) == len(words(text))


def test_minhash_estimates_jaccard_and_blocks_agree():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    b = np.concatenate([a[:2400], rng.integers(0, 2**64, 600, dtype=np.uint64)])
    sig = tk.minhash(np.concatenate([a, b]), np.array([0, 3000, 6000]), 512)
    assert abs((sig[0] == sig[1]).mean() - 2400 / 3600) < 0.08
    low = tk.minhash_blocks(np.concatenate([a, b]), np.array([0, 3000]), 512)
    assert (low.T == sig).all()
    assert (tk.minhash(a[:0], np.array([0, 0]), 4) == 0xFFFFFFFF).all()


def test_sliced_and_null_columns():
    col = pa.array(["zero", None, "one two", "", "three"])[1:]
    parts = [(h, off) for _, _, h, off in tk.word_slices(col)]
    assert np.concatenate([np.diff(o) for _, o in parts]).tolist() == [0, 2, 0, 1]
