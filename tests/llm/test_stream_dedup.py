import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.llm.helpers import same_as_sql
from tidepool.llm import oracle, stream_dedup as sd
from tidepool.session import scratch_path


def plain(rows):
    """Rows (doc_id, text) in order of file and place."""
    keyed = [(i, d, t or "", re.sub(r"[\x20\x09-\x0D]", "", t or "")) for i, (d, t) in enumerate(rows)]
    groups = {}
    for i, d, t, x in keyed:
        groups.setdefault(x, []).append((-len(t), d is None, d or 0, i))
    out = []
    for i, d, t, x in keyed:
        best = min(groups[x])
        out.append((d, None if best[1] else best[2], len(groups[x]), best[3] == i, hashlib.sha256(x.encode()).hexdigest()))
    return sorted(map(repr, out))


def landed(spark, rows, path=None):
    path = path or scratch_path(spark, "test/docs")
    spark.createDataFrame([(d, t, 1, "n") for d, t in rows], "doc_id long, text string, digest int, file string") \
        .coalesce(1).write.mode("append").parquet(path)
    return path


ODD = [(5, "a b c"), (3, "abc"), (4, "a\tb\nc "), (9, "a b c"), (7, None), (8, ""), (1, " \r\n"), (None, "x"), (2, "x"), (None, "only null id"),
       (11, "a\xa0bc"), (12, "a bc"), (13, "é"), (14, "é"), (15, "same"), (15, "same"), (16, "nul\x00"), (17, "nul")]


def test_odd_rows(spark):
    got = sd.exact_duplicates(spark, landed(spark, ODD))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == plain(ODD)


def test_whole_table_matches_sql(spark):
    path = f"{SF001}/documents.parquet"
    same_as_sql(spark, oracle.OP12, sd.exact_duplicates(spark, path), documents=path)


@pytest.mark.parametrize("locators", [sd.LOCATORS, 3])
def test_equal_digests_of_different_texts_are_told_apart(spark, locators, monkeypatch):
    monkeypatch.setattr(sd, "LOCATORS", locators)
    rows = [(i, f"text {i % 7}" + " " * (i % 3)) for i in range(120)] + [(200 + i, "hot") for i in range(200)]
    weak = lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 1))
    assert sorted(map(repr, map(tuple, sd.exact_duplicates(spark, landed(spark, rows), digest=weak).collect()))) == plain(rows)


def test_state_is_kept_between_deliveries(spark):
    rows = [(i, f"text {i % 5}") for i in range(10, 30)]
    folder, path = scratch_path(spark, "test/dedup"), landed(spark, rows)
    first = sd.exact_duplicates(spark, path, folder)
    assert sorted(map(repr, map(tuple, first.collect()))) == plain(rows)
    later = [(1, "text 1"), (2, "text  2"), (99, "text new")]  # a smaller id and a longer text take over
    landed(spark, later, path)
    both = {r["doc_id"]: r for r in sd.exact_duplicates(spark, path, folder).collect()}
    assert len(both) == 23 and both[1]["kept"] and both[11]["keep_id"] == 1 and both[12]["keep_id"] == 2
    assert both[11]["group_size"] == 5 and both[10]["group_size"] == 4 and both[99]["kept"]
    assert len(sd.exact_duplicates(spark, path, folder).collect()) == 23  # nothing new, nothing twice


def test_a_retried_epoch_changes_nothing(spark):
    rows = [(i, f"text {i % 5}") for i in range(40)]
    folder, path = scratch_path(spark, "test/dedup"), landed(spark, rows)
    sd.exact_duplicates(spark, path, folder).collect()
    fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in ("fingerprints", "groups"):
        for x in ("0", ".0.crc"):
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/progress/{name}/commits/{x}"), False)
    assert sorted(map(repr, map(tuple, sd.exact_duplicates(spark, path, folder).collect()))) == plain(rows)


def test_empty_table(spark):
    assert sd.exact_duplicates(spark, landed(spark, [])).collect() == []
    text = "long " * 300_000
    assert [r["group_size"] for r in sd.exact_duplicates(spark, landed(spark, [(1, text), (2, text + "\n")])).collect()] == [2, 2]


def test_state_is_on_disk_and_does_not_expire(spark):
    folder = scratch_path(spark, "test/dedup")
    sd.exact_duplicates(spark, landed(spark, ODD), folder)
    state = spark.read.format("statestore").load(f"{folder}/progress/groups")
    assert state.count() == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in ODD})
