"""The registered queries of the operators, with production parameters over
whole tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.llm.shared import fold

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def _read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def url_labels(labels):
    """Bad documents are toxic or of low quality."""
    return labels.select(F.col("doc_id").alias("key"), F.greatest(1 - F.col("quality"), F.col("toxic")).alias("bad"))


def op1(spark, sf):
    from tidepool.llm.url_templates import filter_urls
    # the number that ends a page's path is the id of its document
    key = F.expr(r"try_cast(nullif(regexp_extract(path, r'/([0-9]+)(\.html)?/?$', 1), '') as bigint)")
    return filter_urls(_read(spark, sf, "pages"), url_labels(_read(spark, sf, "labels")), RULES, key)


def op2(spark, sf):
    from tidepool.llm.embedding_lsh import embedding_near_duplicates
    return embedding_near_duplicates(_read(spark, sf, "embeddings"))


def op3(spark, sf):
    from tidepool.llm.sharding import shard_documents
    return shard_documents(_read(spark, sf, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def _scores(scored, mod, out):
    held = F.coalesce(fold(F.col("doc_id"), mod) == out, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4(spark, sf):
    from tidepool.llm.subword_quality import fit_quality, score_quality
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    model = fit_quality(docs, _read(spark, sf, "labels"), usable=lambda k: fold(k, 4) != 2)
    return _scores(score_quality(docs, model), 4, 2)


def op5(spark, sf):
    from tidepool.llm.license_digest import license_scan
    return license_scan(_read(spark, sf, "documents"))


def op5_notices(spark, sf):
    from tidepool.llm.license_digest import license_report
    return license_report(_read(spark, sf, "documents")).withColumn("notices", F.concat_ws(",", "notices"))


def op6(spark, sf):
    from tidepool.llm.ngram_join import ngram_jaccard_join
    return ngram_jaccard_join(_read(spark, sf, "documents"))


def op7(spark, sf, tokenizer: str | None = None):
    from tidepool.llm.packing import pack_documents
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(_read(spark, sf, "documents"), str(tokenizer)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "sequence_length", "step_group")


def op8(spark, sf):
    from tidepool.llm.toxicity_ftrl import fit_toxicity, score_toxicity
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, _read(spark, sf, "labels"), usable=lambda k: fold(k, 3) != 1)
    return _scores(score_toxicity(docs, model), 3, 1)


def op9(spark, sf):
    from tidepool.llm.decontaminate import contaminated_pairs
    return contaminated_pairs(_read(spark, sf, "documents"), _read(spark, sf, "benchmark"))


def op10(spark, sf):
    from tidepool.llm.warc import archive_pages, read_records
    index, folder = archive_pages(_read(spark, sf, "pages"))
    return read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11(spark, sf):
    from tidepool.llm.whitening import whiten
    return whiten(_read(spark, sf, "embeddings"))


def op12(spark, sf):
    from tidepool.llm.stream_dedup import exact_duplicates
    return exact_duplicates(spark, f"{sf}/documents.parquet")


def op13(spark, sf):
    import public_tokenizers

    from tidepool.llm.token_alignment import align_tokenizers
    return align_tokenizers(_read(spark, sf, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")),
                            str(public_tokenizers.path("piece_bpe_32k.model")))


def pipeline(spark, sf):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf)


QUERIES = {
    "op1_url_templates": op1, "op2_embedding_near_duplicates": op2, "op3_byte_shards": op3, "op4_subword_quality": op4,
    "op5_license_digest": op5, "op5_license_notices": op5_notices,
    "op6_ngram_jaccard_join": op6, "op7_hierarchical_packing": op7, "op8_toxicity_ftrl": op8,
    "op9_decontamination": op9, "op10_warc_normaliser": op10,
    "op11_embedding_whitening": op11, "op12_stream_exact_dedup": op12, "op13_token_alignment": op13, "pipeline": pipeline,
}


def oracle() -> dict[str, str]:
    from tidepool.llm import oracle as o
    return {"op1_url_templates": o.op1_sql(RULES), "op2_embedding_near_duplicates": o.OP2, "op5_license_digest": o.OP5,
            "op5_license_notices": o.OP5_NOTICES,
            "op6_ngram_jaccard_join": o.OP6, "op9_decontamination": o.OP9, "op10_warc_normaliser": o.OP10,
            "op12_stream_exact_dedup": o.OP12}
