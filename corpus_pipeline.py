"""Corpus pipeline: toxic documents go, then exact and near copies, the rest is sampled to target weights and encoded.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame; ``run`` writes each
result to the shared folder and reads it back as the next stage's documents. All but the last return the columns of
``documents``. Null texts count as empty in every stage; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigstat.llm import bpe, exact_dedup, mixing, simhash, toxicity
from sigstat.llm.batches import written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents predicted toxic; the model learns from this stage's labelled documents."""
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each component of near copies."""
    return simhash.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that the expected tokens have the target margins."""
    return mixing.sampled(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded bytes."""
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text")).drop("text"))
    return coded.select("doc_id", "lang", "source", "ids", *bpe.digests(F.col("ids"), F.col("decoded")))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("byte_bpe", encode),
]

#: Learned scores, fingerprints and merges have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
