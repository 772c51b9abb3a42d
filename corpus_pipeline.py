"""The corpus pipeline: five stages over ``documents``, each written as
Parquet and read again as the next one's input.

1. toxicity: documents scored 0.7 or more go (operator 8);
2. quality: documents scored below 0.7 go (operator 4); all stay if the
   labelled documents with text are not of both classes (or there are none);
3. near_duplicates: one document of each group of links stays (operator 6);
4. decontamination: documents that hold a benchmark item go (operator 9);
5. packing: the rest becomes sequences of tokens (operator 7).

Stages 1 to 4 return the columns of ``documents``. Models are fitted on
labelled documents of the stage's own input. No SQL states the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.decontaminate import drop_contaminated
from tidepool.llm.ngram_join import ngram_jaccard_join
from tidepool.llm.packing import pack_documents
from tidepool.llm.shared import BROADCAST_ROWS, new_name, written
from tidepool.llm.subword_quality import score_quality, train, training_rows
from tidepool.llm.toxicity_ftrl import fit_toxicity, score_toxicity
from tidepool.session import scratch_path

REJECT_AT = 0.7


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = new_name(docs, "toxicity_score")
    return score_toxicity(docs, model, score_col=name).where(F.col(name) < REJECT_AT).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = training_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if len({label for label, buckets, _ in rows if len(buckets)}) < 2:  # nothing to tell the classes by
        return docs.select(*docs.columns)
    model = train(rows)
    name = new_name(docs, "quality_score")
    return score_quality(docs, model, score_col=name).where(F.col(name) >= REJECT_AT).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = written(ngram_jaccard_join(docs).where(~F.col("kept")).select("doc_id").distinct(), "copies")
    small = gone.count() <= BROADCAST_ROWS  # ids only; else both sides are shuffled
    return docs.join(F.broadcast(gone) if small else gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    pieces = pack_documents(docs, str(public_tokenizers.path("byte_bpe_50k.json")))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, "llm/pipeline")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
