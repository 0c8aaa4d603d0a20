"""From raw documents to token ids: five stages, each over all that its predecessor kept.

`run` writes every stage's result as Parquet below the shared scratch folder and reads it back,
so a lost executor costs a stage's tasks and not the stages before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lavra.llm import langid, mixing, queries, secret_scan, simhash
from lavra.runtime import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language was found; texts without a letter, and null texts, go."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash neighbours: the one with the smallest id."""
    return simhash.keep_representatives(docs, simhash.SHINGLE_WORDS, simhash.MAX_BITS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    weights = secret_scan.train(secret_scan.labelled_sample(docs))
    return secret_scan.redact(docs, weights)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order; a document is there once per copy it takes."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes, a row per document of the mix."""
    return queries.bpe_report(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_duplicates", near_duplicates),
    ("secret_scan", secrets),
    ("mixing", mix),
    ("byte_level_bpe", encode),
]

# Suffix automata, fingerprints and ranked merges are beyond SQL; the stages' tests compare with
# brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
