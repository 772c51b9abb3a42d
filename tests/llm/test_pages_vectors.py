import gzip
import hashlib
import io
import json

import numpy as np
import pytest

from tests.conftest import SF001
from tests.llm.helpers import same_as_sql
from tidepool.llm import oracle
from tidepool.llm.embedding_lsh import bucket_codes, embedding_near_duplicates, hadamard
from tidepool.llm.graph import components
from tidepool.llm.queries import RULES, url_labels
from tidepool.llm.url_templates import filter_urls
from tidepool.llm.warc import archive_pages, headers, read_records, record, split_records


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "r") for i, v in rows], "vec_id long, embedding array<float>, node int, root string")


def test_rotation_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    y = hadamard(x)
    assert np.allclose((x**2).sum(1), (y**2).sum(1)) and np.allclose(hadamard(y), x)


@pytest.mark.parametrize("codes,dim,n", [(3, 64, 1000), (4, 64, 1000), (5, 64, 1000), (3, 256, 1000), (4, 256, 600), (3, 768, 400)])
def test_recall_at_the_threshold(codes, dim, n):
    rng = np.random.default_rng(codes)
    x = rng.normal(size=(n, dim))
    e = rng.normal(size=x.shape)
    x /= np.linalg.norm(x, axis=1)[:, None]
    e -= (e * x).sum(1)[:, None] * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * e / np.linalg.norm(e, axis=1)[:, None]
    a, b = (bucket_codes(z, codes).reshape(n, -1) for z in (x, y))
    assert np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)]) >= 0.998


def test_every_width_links(spark):
    rng = np.random.default_rng(8)
    rows = []
    for w, n in ((8, 90), (3, 40), (70, 30), (1, 5)):
        base = rng.normal(size=(6, w))
        rows += [(len(rows) + i, (base[i % 6] + rng.normal(size=w) * 0.04).tolist()) for i in range(n)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_near_duplicates(vectors(spark, rows), block=16).collect()}
    link = {i: {j for j, y in rows if j != i and len(x) == len(y) and np.dot(*(np.float32(z).astype(float) / np.linalg.norm(np.float32(z).astype(float))
            for z in (x, y))) >= 0.9} for i, x in rows}
    for i, _ in rows:
        met, todo = {i}, [i]
        while todo:
            new = link[todo.pop()] - met
            met |= new
            todo += new
        assert got[i] == (len(link[i]), min(met))
    few = vectors(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0, 0.0, 0.0]), (5, [1.0, 0.0, 0.0])])
    assert {r["vec_id"]: r["n_links"] for r in embedding_near_duplicates(few).collect()} == {1: 1, 2: 1, 3: 0, 4: 1, 5: 1}


def test_vectors_match_sql(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 8))
    rows = []
    for i in range(200):
        rows.append((i, (base[i % 40] + rng.normal(size=8) * (0.05 if i < 120 else 0.9)).tolist()))
    rows += [(300 + i, rows[0][1]) for i in range(40)]
    rows += [(400, None), (401, [0.0] * 8), (402, [float("nan")] + [1.0] * 7), (403, [float("inf")] + [1.0] * 7),
             (404, [None] + [1.0] * 7), (405, []), (406, [x * 1e20 for x in rows[5][1]]), (407, [-x for x in rows[5][1]])]
    d = vectors(spark, rows)
    same_as_sql(spark, oracle.OP2, embedding_near_duplicates(d, block=16), embeddings=d.select("vec_id", "embedding"))


def test_odd_vectors(spark):
    d = vectors(spark, [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, -0.0]), (3, [1.0, 0.0, 0.0])])
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_near_duplicates(d).collect()}
    assert got == {None: (0, None, False), 1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True)}
    assert embedding_near_duplicates(d.limit(0)).collect() == []
    assert embedding_near_duplicates(vectors(spark, [(5, None)])).count() == 1


@pytest.mark.parametrize("rows", [2_000_000, 0])
def test_components_of_chains_and_rings(spark, monkeypatch, rows):
    from tidepool.llm import graph, shared
    monkeypatch.setattr(shared, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(graph, "BROADCAST_ROWS", rows)
    e = [(i, i + 1) for i in range(100, 160)] + [(3, 1), (1, 2), (2, 3), (9, 9), (None, 4)] + [(500, 500 + i) for i in range(1, 30)]
    got = dict(map(tuple, components(spark.createDataFrame(e, "a long, b long"), "a", "b").collect()))
    assert got == {**{i: 100 for i in range(100, 161)}, 1: 1, 2: 1, 3: 1, **{500 + i: 500 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


URLS = ["http://Foo.Example.NET/en/1?x", "https://example.net/en/2", "http://example.net", "net/x", None, "", "http://a.example.org/fr/9#t",
        "http://example.org/fr", "x://y://z/p", "https://Éa.example.com/de/3", "http://example.comx/de/3", "http://h.example.com/en//7/",
        "http://h.example.com/a/b/c/d/e", "http://net/", "http://evilnet/a", "http:///p", "line\nhttp://q.example.net/en/\n5"]


def test_rules_and_parts(spark):
    d = spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(URLS)], "page_id long, url string, host string, template string")
    none = spark.createDataFrame([], "key long, bad int")
    got = {r["page_id"]: r for r in filter_urls(d, none, RULES).collect()}
    assert len(got) == len(URLS)
    want = {0: ("foo.example.net", "/en/1", "example.net/en/", "allow"), 1: ("example.net", "/en/2", "example.net/en/", "allow"),
            2: ("example.net", "", None, "allow"), 3: ("", "", None, "allow"), 4: ("", "", None, "allow"), 5: ("", "", None, "allow"),
            6: ("a.example.org", "/fr/9", "org/fr/", "allow"), 7: ("example.org", "/fr", None, "allow"), 8: ("y:", "//z/p", None, "allow"),
            9: ("Éa.example.com", "/de/3", "example.com/de/", "block"), 10: ("example.comx", "/de/3", None, "allow"),
            13: ("net", "/", "net/", "block"), 14: ("evilnet", "/a", None, "allow"), 15: ("", "/p", None, "allow"),
            16: ("q.example.net", "/en/\n5", "example.net/en/", "allow")}
    for i, w in want.items():
        assert tuple(got[i][c] for c in ("host", "path", "rule", "verdict")) == w, URLS[i]
    assert filter_urls(d.limit(0), none, RULES).count() == 0


def site(spark):
    rows, lab = [], []
    for i in range(300):
        section = ("news", "blog", "spam")[i % 3]
        rows.append((i, f"https://site.example.com/{section}/{1000 + i}.html"))
        lab.append((i, 1 if section == "spam" and i % 10 else int(i % 23 == 0)))
    return spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(lab, "key long, bad int")


def test_templates_generalise_merge_and_reject(spark):
    pages, lab = site(spark)
    got = {r["page_id"]: r for r in filter_urls(pages, lab, {}).collect()}
    assert {got[i]["template"] for i in (2, 5, 8)} == {"site.example.com/spam/*"}
    assert {got[i]["verdict"] for i in range(2, 300, 3)} == {"block"}
    assert {got[i]["template"] for i in (0, 1, 3, 4)} == {"site.example.com/{blog|news}/*"}
    assert {got[i]["verdict"] for i in range(0, 300, 3)} == {"allow"}


def test_supported_sections_of_a_wide_host_stay(spark):
    # 100 equal sections, each 1 % of the host: at the first level and at the fifth
    for top in ("", "/a/b/c/d"):
        rows = [(i, f"https://wide.example.com{top}/s{i % 100:02d}/{10_000 + i}.html") for i in range(2000)]
        pages = spark.createDataFrame(rows, "page_id long, url string")
        lab = spark.createDataFrame([(i, int(i % 100 == 42)) for i in range(2000)], "key long, bad int")
        got = {r["page_id"]: r for r in filter_urls(pages, lab, {}).collect()}
        assert len(got) == 2000
        assert {i % 100 for i in got if got[i]["verdict"] == "block"} == {42}, top
        assert sum(r["verdict"] == "block" for r in got.values()) == 20
        assert got[42]["template"] == f"wide.example.com{top}/s42/*"
    # a level of identifiers above the sections, and sections without support
    rows = [(i, f"https://deep.example.com/a/b/c/{i}/{('good', 'fine', 'spam')[i % 3]}/{i}/z") for i in range(60)]
    rows += [(100 + i, f"https://deep.example.com/a/b/c/{i}/few{i}") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    lab = spark.createDataFrame([(i, int(i % 3 == 2)) for i in range(60)], "key long, bad int")
    got = {r["page_id"]: r for r in filter_urls(pages, lab, {}).collect()}
    assert len(got) == 80 and {i for i in got if got[i]["verdict"] == "block"} == set(range(2, 60, 3))


def test_graded_rates_do_not_chain(spark):
    # eleven sections with 0, 2, 4 .. 20 bad ones of 20, and a clean host
    rows = [(i, f"https://graded.example.com/s{i % 11:02d}/{1000 + i}.html") for i in range(220)]
    rows += [(1000 + i, f"https://clean.example.org/x/{i}") for i in range(80)]
    lab = [(i, int(i // 11 < 2 * (i % 11))) for i in range(220)] + [(1000 + i, 0) for i in range(80)]
    got = {r["page_id"]: r for r in filter_urls(spark.createDataFrame(rows, "page_id long, url string"),
                                                spark.createDataFrame(lab, "key long, bad int"), {}).collect()}
    worst, best = {got[i]["verdict"] for i in range(10, 220, 11)}, {got[i]["verdict"] for i in range(0, 220, 11)}
    assert (worst, best) == ({"block"}, {"allow"})
    assert len({got[i]["template"] for i in range(11)}) > 2


def test_templates_match_sql(spark):
    pages, lab = site(spark)
    more = spark.createDataFrame([(1000 + i, u) for i, u in enumerate(URLS)] + [(7, "http://dup/x")] * 3, "page_id long, url string")
    labels = lab.selectExpr("key + 1000 as doc_id", "1 - bad as quality", "0 as toxic")
    from pyspark.sql import functions as F
    key = F.expr(r"try_cast(nullif(regexp_extract(path, r'/([0-9]+)(\.html)?/?$', 1), '') as bigint)")
    both = pages.unionByName(more)
    got = filter_urls(both, url_labels(labels), RULES, key)
    same_as_sql(spark, oracle.op1_sql(RULES), got, pages=both, labels=labels)


def test_archives_round_trip(spark, tmp_path):
    rows = [(1, "http://a/", "same"), (2, "http://b/\r\nX: y", "same"), (3, None, "same"), (4, "u", ""), (5, "u", None), (None, "u", "same"),
            (6, "u", "é\r\n\r\nWARC/1.1\r\n"), (7, "u", "x" * 3_000_000), (3, "again", "same")]
    d = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, archive string, ordinal int").repartition(3)
    index, folder = archive_pages(d, f"file://{tmp_path}/w")
    got = read_records(index, folder, with_payload=True).toPandas()
    assert len(got) == len(rows)
    html = {r[0]: (r[2] or "").encode() for r in rows}
    for _, r in got.iterrows():
        p = None if np.isnan(r["page_id"]) else int(r["page_id"])
        assert r["payload_bytes"] == len(html[p])
        kind = {1: 3, 2: 3, 4: 5}.get(p)
        assert (r["record_type"], None if np.isnan(r["refers_to"]) else r["refers_to"]) == ("revisit" if kind else "response", kind)
        assert bytes(r["payload"]) == (b"" if kind else html[p])
    offsets = {}
    for f in (tmp_path / "w").glob("*.idx"):
        raw = f.with_suffix("").read_bytes()
        for line in f.read_text().splitlines():
            e = json.loads(line)
            one = gzip.decompress(raw[e["offset"]:e["offset"] + e["length"]])  # each record is a member
            assert headers(one.split(b"\r\n\r\n")[0])["WARC-Type"] == e["record_type"]
            offsets[f.name] = e["offset"] + e["length"]
        assert len(raw) == offsets[f.name]
    assert archive_pages(d.limit(0))[0].count() == 0


def test_small_payloads_stay_responses(spark):
    d = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = {r["page_id"]: r["refers_to"] for r in read_records(*archive_pages(d, min_bytes=4)).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}


def test_stream_splitter_takes_members_and_refuses_cuts():
    recs = [record("response", i, "u", hashlib.sha1(b"p").hexdigest(), 3, b"p%d\n" % i) for i in range(50)]
    whole, members = gzip.compress(b"".join(recs)), b"".join(map(gzip.compress, recs))
    for raw in (whole, members):
        assert [p for _, p in split_records(io.BytesIO(raw), 7)] == [b"p%d\n" % i for i in range(50)]
    for cut in (len(whole) // 2, len(whole) - 3):
        with pytest.raises(ValueError):
            list(split_records(io.BytesIO(whole[:cut])))
    with pytest.raises(ValueError):
        list(split_records(io.BytesIO(gzip.compress(b"".join(recs)[:-9]))))


def test_queries_match_sql_at_the_smallest_size(spark):
    from tidepool.llm.queries import QUERIES, oracle as twins
    files = {t: f"{SF001}/{t}.parquet" for t in ("documents", "embeddings", "pages", "benchmark", "labels")}
    for name, sql in twins().items():
        same_as_sql(spark, sql, QUERIES[name](spark, SF001), **files)
