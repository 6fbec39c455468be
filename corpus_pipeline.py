"""The training-data pipeline: toxicity filter, exact dedup, SimHash near-dedup,
mixing to target weights, tokenisation. Every stage works on all rows that its
predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import byte_bpe, exact_dedup, mixing, simhash, toxicity
from tessera.llm.common import scratch, table
from tessera.llm.queries import PATTERN, TOKENIZER


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on the labelled ones, does not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts, that with the largest doc_id."""
    return exact_dedup.keep_one_of_each(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every SimHash component, that with the smallest doc_id."""
    return simhash.keep_one_per_component(docs, shingle=4, distance=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix to the sources' target weights takes it."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of the bytes they decode to."""
    ids = byte_bpe.encode(docs, TOKENIZER, PATTERN, carry=("doc_id", "lang", "source"))
    both = byte_bpe.decode(ids, TOKENIZER, carry=("doc_id", "lang", "source", "ids"))
    return both.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", clean), ("exact_dedup", exact), ("simhash_dedup", near), ("mixing", mix), ("byte_bpe", tokenize)]

#: Learned weights and fingerprint components are beyond SQL; the tests hold
#: every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
