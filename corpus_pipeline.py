"""A corpus pipeline of five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a frame; :func:`run`
writes it as Parquet in the shared folder and reads it back for the next
one. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, exact_dedup, language, mixing, simhash
from tessera.llm.common import load
from tessera.session import drop_folder, scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language, under the one that is predicted for them."""
    return language.drop_unidentified(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the largest id, of each text."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each SimHash component (3 words, 3 bits)."""
    return simhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none to three times."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document of the mix."""
    return bpe.token_digests(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mixing", mix),
    ("bpe", encode),
]

# Language prediction, SimHash and byte-pair merges are beyond SQL; see tests/llm/test_llm_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table through all stages; the last stage's rows."""
    docs, previous = load(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        out, path = stage(spark, docs, sf_dir), scratch(spark)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if previous:
            drop_folder(spark, previous)
        previous = path
    return docs
