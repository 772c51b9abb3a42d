"""Operators on documents against brute force, and their defined cases."""
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, SF01
from tests.llm.helpers import norm, same_as_sql
from tidepool.llm import oracle
from tidepool.llm.decontaminate import contaminated_pairs, drop_contaminated
from tidepool.llm.labelled import labelled_sample
from tidepool.llm.license_digest import KNOWN, license_report, license_scan, line_notices
from tidepool.llm.ngram_join import least_matches, ngram_jaccard_join
from tidepool.llm.packing import encoder, pack_block, pack_documents
from tidepool.llm.sharding import shard_documents
from tidepool.llm.shared import block_pairs
from tidepool.llm.subword_quality import fit_quality, score_quality
from tidepool.llm.toxicity_ftrl import fit_toxicity, score_toxicity

LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
BASE = "the quick brown fox jumps over the lazy dog and runs far away into the deep dark forest where nobody ever goes at night because of the many wolves and bears that live there all year round".split()


def docs(spark, rows):
    """With extra columns of clashing names."""
    return spark.createDataFrame(
        [(i, t, "k", 5, -1, 2.0, "r", True) for i, t in rows],
        "doc_id long, text string, key string, n int, class_id long, score double, root string, kept boolean")


def odd_rows():
    changed = list(BASE)
    changed[18] = "bright"
    return [(1, " ".join(BASE)), (2, "  ".join(BASE).upper() + "!"), (3, " ".join(BASE + ["again"])), (4, " ".join(changed)),
            (5, ""), (6, None), (7, "two words"), (8, "Two, words"), (9, LONG), (10, LONG + " end"), (11, "..."),
            (None, " ".join(BASE)), (None, None), (12, "other text of exactly eight words right here"),
            (12, "other text of exactly eight words right here"), (13, "x")]


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, odd_rows()).cache()


def test_join_matches_sql_on_odd_rows(spark, odd):
    plain = odd.where("doc_id is not null").select("doc_id", "text").distinct()
    same_as_sql(spark, oracle.OP6, ngram_jaccard_join(plain), documents=plain)
    out = {r["doc_id"]: r for r in ngram_jaccard_join(odd).collect()}
    assert ngram_jaccard_join(odd).count() == odd.count()
    assert out[2]["class_id"] == 1 and out[3]["component_id"] == 1 and out[1]["n_links"] >= 2
    assert out[5]["kept"] and out[6]["n_links"] == 0 and out[8]["class_id"] == 7 and out[10]["component_id"] == 9
    assert out[None]["component_id"] is None and out[None]["kept"] and out[12]["n_links"] == 0


def test_join_of_empty_table(spark, odd):
    assert ngram_jaccard_join(odd.limit(0)).collect() == []


def test_join_counts_every_link_of_a_large_group(spark):
    """Near copies over several blocks: links are counted once each."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(90):
        w = list(BASE * 4)
        for at in rng.choice(len(w), rng.integers(1, 4), replace=False):
            w[at] = f"z{rng.integers(1000)}"
        rows.append((i, " ".join(w)))
    d = spark.createDataFrame(rows + [(100 + i, rows[0][1]) for i in range(30)], "doc_id long, text string")
    same_as_sql(spark, oracle.OP6, ngram_jaccard_join(d, block=16), documents=d)


def test_posterior_bound():
    assert least_matches(128, 0.8, 1e-6) < 0.7 * 128 < 0.8 * 128
    assert least_matches(32, 0.8, 1e-6) < least_matches(32, 0.9, 1e-6)


def test_block_pairs_meet_once_in_each_combination(spark):
    d = spark.createDataFrame([(1, 50, i) for i in range(50)], "g long, size long, m long")
    got = block_pairs(d, ["g"], "size", "m", 8).collect()
    meet = {}
    for r in got:
        meet.setdefault((r["_bi"], r["_bj"]), []).append((r["m"], r["_b"]))
    pairs = []
    for (i, j), ms in meet.items():
        pairs += [tuple(sorted((a, b))) for k, (a, x) in enumerate(ms) for b, y in ms[k + 1:] if i == j or x != y]
    assert len(pairs) == len(set(pairs)) == 50 * 49 // 2


def test_decontamination_matches_sql(spark, odd):
    items = spark.createDataFrame([(1, " ".join(BASE[:20])), (2, "Two words"), (3, ""), (None, None), (4, " ".join(BASE[10:35])),
                                   (5, " ".join(LONG.split()[31_000:31_030])), (5, " ".join(LONG.split()[31_000:31_030])),
                                   (6, "nothing of this kind occurs in any of the texts")], "item_id long, text string")
    plain = odd.where("doc_id is not null")
    got = contaminated_pairs(plain, items)
    same_as_sql(spark, oracle.OP9, got, documents=plain.select("doc_id", "text"), benchmark=items)
    left = drop_contaminated(odd, items)
    assert left.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 5, 6, 11, 12, 12, 13]
    assert contaminated_pairs(odd.limit(0), items).count() == 0
    assert contaminated_pairs(odd, items.limit(0)).count() == 0
    assert drop_contaminated(odd, items.limit(0)).count() == odd.count()


def test_decontamination_in_chunks(spark, odd, monkeypatch):
    from tidepool.llm import decontaminate
    items = spark.createDataFrame([(i, " ".join(BASE[i:i + 12])) for i in range(20)], "item_id long, text string")
    whole = norm(contaminated_pairs(odd, items).toPandas())
    monkeypatch.setattr(decontaminate, "CHUNK_ITEMS", 6)
    assert norm(contaminated_pairs(odd, items).toPandas()) == whole and len(whole[0]) > 20


def test_item_texts_under_many_ids_are_indexed_once(spark, odd, monkeypatch):
    from tidepool.llm import decontaminate as dc
    long_, short = " ".join(BASE[:30]), " ".join(BASE[5:17])
    items = spark.range(3000).select(F.col("id").alias("item_id"), F.lit(long_).alias("text")).unionByName(
        spark.createDataFrame([(9000, short), (9001, short), (None, short), (9002, None)], "item_id long, text string"))
    texts, members = dc.item_texts(items)
    monkeypatch.setattr(dc, "CHUNK_BYTES", len(long_))  # each text is a chunk of its own
    indexes = dc.text_indexes(texts)
    assert sorted(len(i.value.sets) for i in indexes) == [1, 1] and members.count() == 3003
    plain = odd.where("doc_id is not null")
    same_as_sql(spark, oracle.OP9, dc.contaminated_pairs(plain, items.where("item_id is not null")),
                documents=plain.select("doc_id", "text"), benchmark=items)
    nulls = dc.contaminated_pairs(plain, items).where("item_id is null")
    assert 0 < nulls.count() == nulls.select("doc_id").distinct().count()


def test_chunks_hold_their_bounds(spark, monkeypatch):
    from tidepool.llm import decontaminate as dc
    rows = [(bytes([i]), "w" * (10 * i)) for i in range(40)] + [(b"big", "x" * 5000)]
    texts = spark.createDataFrame(rows, "key binary, text string")
    monkeypatch.setattr(dc, "CHUNK_BYTES", 600)
    monkeypatch.setattr(dc, "CHUNK_ITEMS", 5)
    parts, used = dc._chunks(texts)
    got = texts.groupBy(F.pmod(F.xxhash64("key"), F.lit(parts)).alias("p")).agg(
        F.count("*").alias("n"), F.sum(F.length("text")).alias("size")).collect()
    assert sorted(r["p"] for r in got) == used and sum(r["n"] for r in got) == 41
    assert all(r["n"] == 1 or (r["n"] <= 5 and r["size"] <= 600) for r in got)
    assert dc._chunks(texts.limit(0)) == (1, [])


def test_training_sample_keeps_to_its_bytes(spark):
    from tidepool.llm.labelled import fetch, within_budget
    assert within_budget([(0, 1, 50), (0, 2, 60), (1, 3, 100), (0, 4, 50), (1, 5, 1), (0, 6, 0)], 100) == [1, 3, 4, 6]
    rows = [(i, i % 2, np.full(i, i, np.uint64).tobytes()) for i in range(40)] + [(99, 1, np.zeros(10_000, np.uint64).tobytes())]
    sample = spark.createDataFrame(rows, "doc_id long, label int, f binary")
    every = fetch(sample, {"f": np.uint64})
    assert [len(f) for _, f in every] == [*range(40), 10_000]
    some = fetch(sample, {"f": np.uint64}, budget=800)
    kept = {(y, len(f)) for y, f in some}
    assert all(sum(8 * n for y, n in kept if y == k) <= 800 for k in (0, 1)) and {y for y, _ in kept} == {0, 1}
    assert kept < {(y, len(f)) for y, f in every} and some[0][0] == 0
    assert [f.tolist() for _, f in fetch(sample.repartition(7), {"f": np.uint64}, budget=800)] == [f.tolist() for _, f in some]
    assert fetch(sample.limit(0), {"f": np.uint64}) == []


def test_licence_digests(spark, odd):
    mit = dict(KNOWN)["MIT"]
    rows = [(1, "Copyright (c) 2020 A. Author\n\n" + mit), (2, mit.upper().replace(",", " ;")), (3, mit + " x"), (4, None), (5, ""),
            (6, "(C) 1999 B\nreleased under  the MIT Licence"), (7, "intro\nLicensed under CC BY-NC 4.0.\nmore"), (8, LONG)]
    d = docs(spark, rows)
    got = {r["doc_id"]: r["licence"] for r in license_scan(d).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: None, 4: None, 5: None, 6: "MIT-notice", 7: None, 8: None}
    assert [tuple(r) for r in line_notices(d).where("doc_id = 7").collect()] == [(7, 1, "CC-BY-NC-4.0-notice")]
    same_as_sql(spark, oracle.OP5, license_scan(d), documents=d.select("doc_id", "text"))
    assert license_scan(odd.limit(0)).count() == 0 and license_scan(odd).count() == odd.count()


def test_notices_and_full_texts_are_reported(spark):
    from tidepool.llm.queries import QUERIES
    full = {}
    for name, text in KNOWN:
        full.setdefault(name, text)
    names = ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense"]
    rows = [(i, full[n].replace("\n", "\r\n")) for i, n in enumerate(names)]
    rows += [(50, "a\nLicensed under CC BY-NC 4.0.\nb\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0."),
             (51, None), (None, "x\nReleased under the MIT License.")]
    d = docs(spark, rows)
    got = {r["doc_id"]: (r["licence"], r["notices"]) for r in license_report(d).collect()}
    assert [got[i][0] for i in range(len(names))] == names
    assert got[50] == (None, ["CC-BY-NC-4.0-notice", "MIT-notice"]) and got[51] == (None, [])
    assert got[None] == (None, ["MIT-notice"]) and len(got) == len(rows)
    same_as_sql(spark, oracle.OP5, license_scan(d), documents=d.select("doc_id", "text"))
    assert QUERIES["op5_license_notices"](spark, SF001).count() == spark.read.parquet(f"{SF001}/documents.parquet").count()
    joined = license_report(d).withColumn("notices", F.concat_ws(",", "notices"))
    same_as_sql(spark, oracle.OP5_NOTICES, joined, documents=d.select("doc_id", "text"))
    same_as_sql(spark, oracle.OP5_NOTICES, QUERIES["op5_license_notices"](spark, SF001), documents=f"{SF001}/documents.parquet")
    assert license_report(d.limit(0)).count() == 0


def test_shards_are_contiguous_and_balanced(spark, odd):
    d = spark.read.parquet(f"{SF01}/documents.parquet")
    got = shard_documents(d).toPandas().sort_values("doc_id")
    text = d.toPandas().set_index("doc_id")["text"]
    size = np.array([len(text[i].encode()) + 1 for i in got["doc_id"]])
    assert (got["size"].to_numpy() == size).all()
    assert got["text_crc32"].tolist() == [zlib.crc32(text[i].encode()) for i in got["doc_id"]]
    prefix = np.concatenate([[0], np.cumsum(size)[:-1]])
    assert (got["shard"].to_numpy() == prefix * 16 // size.sum()).all()
    for _, g in got.groupby("shard"):
        assert g["slot"].tolist() == list(range(len(g)))
    per = got.groupby("shard")["size"].sum()
    assert per.max() - per.min() <= 2 * size.max()
    odd_got = shard_documents(odd).collect()
    assert len(odd_got) == odd.count() and {r["size"] for r in odd_got if r["doc_id"] in (5, 6)} == {1}
    same = docs(spark, [(7, "same")] * 200)
    per = shard_documents(same).groupBy("shard").count().collect()
    assert len(per) == 16 and max(r["count"] for r in per) <= 13
    assert shard_documents(odd.limit(0)).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    P = pytest.importorskip("public_tokenizers")
    return str(P.path("byte_bpe_50k.json"))


def test_token_ids_equal_the_library(spark, vocabulary):
    from tokenizers import Tokenizer
    t, enc = Tokenizer.from_file(vocabulary), encoder(vocabulary)
    texts = [r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    texts += ["", "a<|endoftext|>b", "  two\n\n\tspaces   ", "don't WON'T i'll", "日本語 κόσμε \u200b\u0085\u00a0\u3000x", "½²³ ①", "x" * 3000, "😀\U0001fae0", "e\u0301 ǅ ſ\u017f"]
    texts += [chr(c) + "a " + chr(c) + "1" for c in [*range(0x20, 0x180), 0x2010, 0x2015, 0x2027, 0x20AC]]
    for x in texts:
        assert enc(x).tolist() == t.encode(x, add_special_tokens=False).ids, x[:50]


def test_packing_round_trip(spark, odd, vocabulary):
    enc = encoder(vocabulary)
    for d in (odd, spark.read.parquet(f"{SF001}/documents.parquet")):
        got = pack_documents(d.where("doc_id is not null").dropDuplicates(["doc_id"]), vocabulary).toPandas()
        texts = {r["doc_id"]: r["text"] or "" for r in d.collect()}
        for i, g in got.groupby("doc_id"):
            g = g.sort_values("start")
            ids = np.concatenate([np.frombuffer(b, "<u4") for b in g["ids"]])
            assert ids.tolist() == [*enc(texts[i]).tolist(), 0] and set(g["doc_tokens"]) == {len(ids)}
            assert g["start"].tolist() == [0, *np.cumsum(g["length"])[:-1]]
        pad = 0
        for _, g in got.groupby("sequence_id"):
            g = g.sort_values("offset")
            assert g["offset"].tolist() == [0, *np.cumsum(g["length"])[:-1]]
            used, room = g["length"].sum(), g["sequence_length"].iloc[0]
            assert used <= room <= 1024 and (room == 1024 or (used == room and room & (room - 1) == 0))
            pad += room - used
        assert pad < 1024 * 8  # at most one window a block
        per = got.drop_duplicates("sequence_id").groupby("step_group")["sequence_length"].sum()
        assert per.max() <= 8192
    assert pack_documents(odd, vocabulary).where("start = 0").count() == odd.count()
    assert pack_documents(odd.limit(0), vocabulary).count() == 0


def test_pack_block_wastes_one_window_at_most():
    rng = np.random.default_rng(5)
    for _ in range(30):
        n = rng.integers(1, 3000, rng.integers(1, 200)).tolist()
        pieces, padded, groups = pack_block(n)
        assert sum(p[2] for p in pieces) == sum(n) and sum(padded) - sum(n) < 1024
        assert len(groups) == len(padded)
        steps = np.bincount(groups, padded)
        assert (steps[:-1] == 8192).all()
    assert pack_block([]) == ([], [], [])


def test_sample_is_bounded_and_majority_labelled(spark, odd):
    lab = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (2, 0), (3, None), (None, 1), (7, 1), (8, 0), (8, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r["label"] for r in labelled_sample(odd, lab, "quality", lambda k: k != 7).collect()}
    assert got == {1: 1, 2: 0, 8: 1}
    assert labelled_sample(odd, lab, "quality", lambda k: k > 0, per_class=1).count() == 2


def test_classifiers_on_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for fit, score in ((fit_quality, score_quality), (fit_toxicity, score_toxicity)):
        got = score(odd, fit(odd, none), score_col="p")
        assert got.columns == [*odd.columns, "p"] and {r["p"] for r in got.collect()} == {0.5} and got.count() == odd.count()
        one = spark.createDataFrame([(1, 1, 1), (9, 1, 1)], "doc_id long, quality int, toxic int")
        assert all(0 <= r["p"] <= 1 for r in score(odd, fit(odd, one), score_col="p").collect())
        assert score(odd.limit(0), fit(odd.limit(0), one), score_col="p").count() == 0
        with pytest.raises(ValueError):
            score(odd, fit(odd, none))  # the column exists


def test_sparse_toxicity_score_equals_the_plain_sum(spark):
    d = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    lab = spark.read.parquet(f"{SF001}/labels.parquet")
    model = fit_toxicity(d, lab)
    from tidepool.llm import textkernel as tk
    from tidepool.llm.toxicity_ftrl import _grams
    import pyarrow as pa
    weight = dict(zip(model[0].tolist(), model[1].tolist()))
    for r in score_toxicity(d, model).collect():
        _, _, w, off = next(tk.word_slices(pa.array([r["text"]])))
        z = model[2] + sum(weight.get(f, 0.0) for f in set(_grams(w, off)[0].tolist()))
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-6


def test_quality_score_equals_the_average_of_features(spark):
    import pyarrow as pa

    from tidepool.llm.subword_quality import BITS, _features, _sums
    rng = np.random.default_rng(1)
    table = rng.normal(size=1 << BITS).astype(np.float32)
    texts = pa.array([t for _, t in odd_rows()], pa.string())
    plain = {}
    for lo, n, b, r in _features(texts, BITS):
        for k in range(n):
            plain[lo + k] = (table[b[r == k]].astype(float).sum(), int((r == k).sum()))
    for lo, n, total, count in _sums(pa.compute.fill_null(texts, ""), table, BITS):
        for k in range(n):
            assert count[k] == plain[lo + k][1] and abs(total[k] - plain[lo + k][0]) < 1e-2


def test_held_out_accuracy(spark):
    """Planted junk and insults, learned from a part and judged on the rest."""
    rng = np.random.default_rng(7)
    common = ["w" + "".join(rng.choice(list("aeiourstln"), 4)) for _ in range(300)]
    rows, lab = [], []
    for i in range(400):
        w = list(rng.choice(common, 60))
        bad, low = i % 4 == 0, i % 5 == 0
        if bad:
            w[int(rng.integers(60))] = "insult" + str(rng.integers(3))
        rows.append((i, " ".join(x + "!!" for x in w).upper() if low else " ".join(w)))
        lab.append((i, int(not low), int(bad)))
    d, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(lab, "doc_id long, quality int, toxic int")
    q = {r["doc_id"]: r["score"] for r in score_quality(d, fit_quality(d, labels, usable=lambda k: k % 2 == 0)).collect()}
    t = {r["doc_id"]: r["score"] for r in score_toxicity(d, fit_toxicity(d, labels, usable=lambda k: k % 3 != 0)).collect()}
    assert np.mean([(q[i] >= 0.7) == bool(good) for i, good, _ in lab if i % 2]) > 0.97
    assert np.mean([(t[i] >= 0.7) == bool(bad) for i, _, bad in lab if i % 3 == 0]) > 0.95


def test_no_row_leaves_the_words_pattern_unstated():
    assert re.fullmatch(r"\[0-9a-z.*\]\+", __import__("tidepool.llm.textkernel", fromlist=["x"]).WORD_RE)
