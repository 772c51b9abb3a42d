"""Operator 13 against a plain alignment of whole texts, token by token."""

import hashlib
import json
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.conftest import SF001
from tidepool.llm import token_alignment as ta
from tidepool.llm.packing import byte_ranks

A, B = str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    from tokenizers.pre_tokenizers import ByteLevel
    letters = sorted(ByteLevel.alphabet())
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    order = sorted(own) + [x for x in range(256) if x not in own]
    byte = {c: x for c, x in zip(letters, order, strict=True)}

    def bytes_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def one(text):
        if not text:
            return [], [], []
        x = a.encode(" " + text, add_special_tokens=False)
        ids_a, ids_b = x.ids, b.encode(text)
        raw_a, raw_b = [bytes(byte[c] for c in t) for t in x.tokens], [bytes_b(i) for i in ids_b]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            return [], [], []
        groups, links, i, j, p, q = [], [], 0, 0, 0, 0
        ga, gb = [], []
        while i < len(ids_a) or j < len(ids_b):
            if p <= q and i < len(ids_a):
                ga.append(ids_a[i])
                p += len(raw_a[i])
                i += 1
            else:
                gb.append(ids_b[j])
                q += len(raw_b[j])
                j += 1
            if p == q and ga and gb:
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                links.append((ga[-1], gb[-1]))
                ga, gb = [], []
        return (ids_a, ids_b, groups), links, None

    def rows(docs):
        done = [(d, *one(t)[:2]) for d, t in docs]
        n = Counter(x for _, _, links in done for x in links)
        best = {}
        for (_, y), c in n.items():
            best[y] = max(best.get(y, 0), c)
        out = []
        for d, t, links in done:
            ids_a, ids_b, groups = t or ([], [], [])
            out.append((d, len(ids_a), len(ids_b), len(groups), len(links), sum(n[x] == best[x[1]] for x in links),
                        sum(n[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
        return out
    return rows


ODD = ["", None, " ", "  two  spaces ", "tab\tand\nlines \n x", "<|endoftext|> and <s> and <0x41>", "a▁b", "日本語のテキスト、長い",
       "😀 emoji 😀", "nul\x00 \x02 bell\x07", "x " * 50, " odd  spaces  　here", "don't we're I'll 123 4567 a1b2", "a", "ends with space ",
       "don't we're I'll 123 4567 a1b2", "ﬁ Å é é", "a\x1c b \x1c c", " leading"]


def test_texts_match_the_plain_alignment(spark, plain):
    docs = list(enumerate(ODD)) + [(None, "a null id"), (3, "a second row of an id")]
    d = spark.createDataFrame([(i, t, i, "n") for i, t in docs], "doc_id long, text string, link long, row string").repartition(3)
    got = ta.align_tokenizers(d, A, B)
    assert got.columns == COLUMNS
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain(docs)))


@pytest.mark.parametrize("limit", [None, 40])
def test_documents_match_the_plain_alignment(spark, plain, limit):
    few = {"units": limit, "pairs": limit} if limit else {}  # units are forgotten and pairs handed on again and again
    d = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    if limit:
        d = d.unionByName(d.where("doc_id % 3 = 0"))  # repeated rows
    docs = [tuple(r) for r in d.collect()]
    assert sorted(map(tuple, ta.align_tokenizers(d.repartition(3), A, B, **few).collect())) == sorted(plain(docs))


def test_whole_texts_where_units_are_not_safe(plain):
    pair = ta._Pair(A, B)
    assert pair.by_unit
    whole = ta._Pair(A, B)
    whole.by_unit = False
    texts = ODD + ["many words " * 300 + "ﬁn"]
    x, y = pair.align(texts), whole.align(texts)
    assert (x[0] == y[0]).all() and x[1] == y[1]
    assert all((p == q).all() for k in x[2] for p, q in zip(x[2][k], y[2][k], strict=True))


def test_only_a_file_in_merge_order_is_read_by_ranks():
    with open(A, encoding="utf-8") as f:
        spec = json.load(f)
    assert len(byte_ranks(spec)) == 50256
    model = spec["model"]
    for change in ({"merges": [*model["merges"][1:], model["merges"][0]]}, {"merges": model["merges"][:-1]}, {"byte_fallback": True},
                   {"unk_token": "?"}, {"ignore_merges": True}, {"continuing_subword_prefix": "##"}):
        assert byte_ranks({**spec, "model": model | change}) is None
    assert byte_ranks({**spec, "normalizer": {"type": "NFC"}}) is None


def test_hot_text_and_empty_table(spark, plain):
    docs = [(i, "the same words, again and again") for i in range(300)] + [(i, f"text number {i}") for i in range(300, 420)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, ta.align_tokenizers(d, A, B).collect())) == sorted(plain(docs))
    assert ta.align_tokenizers(d.limit(0), A, B).collect() == []


def test_long_text_without_blanks(spark, plain):
    docs = [(1, "漢字" * 40_000), (2, "a,b;" * 40_000), (3, "word " * 40_000)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, ta.align_tokenizers(d, A, B).collect())) == sorted(plain(docs))
