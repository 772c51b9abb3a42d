import corpus_pipeline
from tests.conftest import SF001

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    have = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF001)
        assert docs.columns == COLUMNS, name
        left = docs.count()
        assert 0.6 * have < left <= have, name
        have = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
    assert packed.where("start = 0").count() == have


def test_stages_on_odd_and_empty_rows(spark):
    text = "some ordinary words in a row that make one plain sentence of a normal kind"
    rows = [(1, text, "en", "s", 1), (2, text, None, None, None), (3, None, "en", "s", 0), (4, "", "en", "s", 0), (None, text, "en", "s", 1),
            (5, "word " * 30_000, "en", "s", 1), (6, text + " x", "en", "s", 1), (6, text + " x", "en", "s", 1)]
    docs = spark.createDataFrame([(*r, 1.0, True) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, toxicity_score double, kept boolean")
    for d in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            got = stage(spark, d, SF001)
            got.count()
    left = corpus_pipeline.near_duplicates(spark, docs, SF001)
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 3, 4, 5]


def test_one_document_of_each_group_stays(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    left = corpus_pipeline.near_duplicates(spark, docs, SF001)
    assert left.count() == left.select("text").distinct().count()
    assert left.join(docs, "text").select("text").distinct().count() == left.count()


def test_run_returns_packed_rows(spark):
    out = corpus_pipeline.run(spark, SF001)
    assert out.count() > 0 and "ids_crc32" in out.columns


def test_quality_keeps_its_input_without_both_classes(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    cases = {"empty": labels.limit(0), "null": labels.selectExpr("doc_id", "cast(null as int) as quality", "toxic"),
             "unknown": labels.selectExpr("-1 - doc_id as doc_id", "quality", "toxic"),
             "bad": labels.where("quality = 0"), "good": labels.where("quality = 1")}
    for name, some in cases.items():
        some.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        assert corpus_pipeline.quality(spark, docs, f"{tmp_path}/{name}").count() == docs.count(), name
