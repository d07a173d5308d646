"""The corpus pipeline: documents through five of the training-data operators, each stage stored and read again.

Every filtering stage keeps all columns of the documents that stay; the last one returns token ids and decoded text
digests.  Each stage works on all that its predecessor kept.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtel.llm import bpe, decontam, exact_dedup, minhash, toxicity
from gridtel.llm.common import stored, table
from gridtel.llm.queries import byte_bpe_path
from gridtel.session import apply_conf


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, trained on the labelled ones, does not reject."""
    apply_conf(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts, the document with the largest doc_id."""
    apply_conf(spark)
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near duplicates, the document with the smallest doc_id."""
    apply_conf(spark)
    return minhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages, by the contamination rule."""
    apply_conf(spark)
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token count, and digests of the ids and of the text decoded from them."""
    apply_conf(spark)
    both = bpe.round_trip(docs, byte_bpe_path())
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", exact_copies), ("near_dedup", near_copies),
          ("decontamination", decontaminate), ("bpe", encode)]

# A trained classifier and a tokenizer are not SQL: tests compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stored as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
