"""From raw documents to training tokens in five stages, each an operator of churnlens.llm.

Every stage takes what its predecessor kept, written as Parquet and read again, and all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm import bpe, ordinal
from churnlens.llm.line_dedup import without_common_lines
from churnlens.llm.lsa_decontam import decontaminate
from churnlens.llm.near_dup import near_duplicates
from churnlens.llm.store import written
from churnlens.session import ship_package

SIMILARITY_PERCENT = 80


def stage(function):
    """A stage can be called alone: the Python workers get this package first."""
    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, docs, sf_dir)
    return run


@stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade is at least one half."""
    model = ordinal.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return ordinal.select_documents(docs, model)


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Common blocks leave the later document; a document that loses its last word goes."""
    cut = without_common_lines(docs).where((F.col("n_cut") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    chars = F.when(F.col("n_cut") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the smallest doc_id (NULL comes last), then the least text hash.

    Texts are compared, not ids: repeated rows, texts under NULL ids and different texts under one id take part
    each for itself, and no clean text goes with another.  Texts without words all stay.
    """
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.where(words).withColumn("_text", F.xxhash64("text"))
    groups = (near_duplicates(rows.select(F.col("_text").alias("doc_id"), "text"), SIMILARITY_PERCENT)
              .select(F.col("doc_id").alias("_text"), "component_id").distinct())
    held = rows.groupBy("_text", F.col("doc_id").alias("_least")).agg(F.count("*").alias("_n"))
    best = F.min(F.struct(F.col("_least").isNull(), "_least", "_text", "_n")).alias("_b")
    kept = held.join(groups, "_text").groupBy("component_id").agg(best).select(
        F.col("_b._text").alias("_text"), F.col("_b._least").alias("_least"), F.col("_b._n").alias("_n"))
    one = rows.join(written(kept, "kept"), "_text").where("doc_id <=> _least")
    # only rows that repeat as they are need a shuffle of texts
    return (one.where("_n = 1").select(*docs.columns)
            .unionByName(one.where("_n > 1").dropDuplicates(["_text"]).select(*docs.columns))
            .unionByName(docs.where(~words).select(*docs.columns)))


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    # the verdict is the text's: NULL and repeated doc_ids take no other row along and save none
    text_key = F.xxhash64("text")
    found = decontaminate(docs.select(text_key.alias("doc_id"), "text"),
                          spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    # written first: its size decides the join, which else shuffles all texts before it is known
    rejected = written(found.where("not kept").select(F.col("doc_id").alias("_text")).distinct(), "rejected")
    return docs.withColumn("_text", text_key).join(rejected, "_text", "left_anti").select(*docs.columns)


@stage
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) with their digests."""
    encoded = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("bpe encoding", encoding),
]

ORACLE_SQL = None  # SQL expresses neither the classifier nor the encoding


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = written(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
