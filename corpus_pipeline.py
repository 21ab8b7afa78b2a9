"""Corpus pipeline: documents in, packed training sequences out.

Each stage is one operator of ``aspectflow.llm`` at work on all that its predecessor kept.  The first four return the
columns of ``documents``; the last one returns the place of every piece of every document in a sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aspectflow.llm import jaccard, langid, mixing, packing, quality
from aspectflow.llm.stored import stored


IDS_BYTES = 64 << 20     # a list of documents to drop goes to the texts up to this size; beyond it Spark shuffles both


def sent(ids: DataFrame) -> DataFrame:
    """``ids`` (a stored table of two longs at most), marked for broadcast if its counted size allows it."""
    return F.broadcast(ids) if ids.count() * 24 <= IDS_BYTES else ids


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the documents outside the held-out fold; documents without a language or torn between two go."""
    model = langid.fit(docs.where(~langid.held_out(docs)))
    return (langid.identified(docs, model).where(f"lang_pred != '{langid.UNDETERMINED}' and not ambiguous")
            .select(*docs.columns))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity lies above their language's limit go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rejected = stored(quality.judged(docs, labels).where("not kept").select(
        F.col("doc_id").alias("__id"), F.col("text_id").alias("__text")).distinct(), "rejected")
    return docs.join(sent(rejected), F.col("doc_id").eqNullSafe(F.col("__id")) & F.xxhash64("text").eqNullSafe(F.col("__text")), "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the row with the smallest doc_id, then text hash, stays; a repeated row stays once.

    Rows are told apart by doc_id and text, as ids may be null or repeated.
    """
    classes = stored(jaccard.headed(docs), "classes")
    first = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_id") == F.col("head.text_id"))
    extra = stored(classes.where(~first).select(F.col("doc_id").alias("__id"), F.col("text_id").alias("__text")).distinct(), "extra")
    kept = docs.join(sent(extra), F.col("doc_id").eqNullSafe(F.col("__id")) & F.xxhash64("text").eqNullSafe(F.col("__text")), "left_anti")
    if classes.groupBy("doc_id", "text_id").count().where("count > 1").limit(1).count():
        kept = kept.withColumn("__text", F.xxhash64("text")).dropDuplicates(["doc_id", "__text"]).drop("__text")
    return kept


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated (or left out) by Poisson draws at their source's rate, in random order."""
    return mixing.mixed(docs).select(*docs.columns)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece in sequences of 2048 ids."""
    return packing.packed(docs)


STAGES = [("language_id", language_id), ("quality_classifier", quality_classifier), ("near_duplicates", near_duplicates),
          ("source_mix", source_mix), ("sequence_packing", sequence_packing)]

# Model fitting, shingle hashing and tokenizers are not SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``; each result is stored and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
