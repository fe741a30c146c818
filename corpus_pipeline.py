"""The corpus pipeline: each stage is one operator of ``opinio.llm``, written as Parquet and read again.

Every stage works on all that its predecessor kept and is judged on its own
input.  All but the last return the columns of their input.  Null texts and ids,
empty or repeated rows and extra columns are handled as the operators say; an
empty table passes through as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opinio.llm import bpe, importance, mixing, simhash
from opinio.llm.common import cut, table

# The vocabulary of the last stage.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on ``labels``, draws stay; the others go."""
    return importance.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by their fingerprints, the one of smallest doc_id stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: some not at all, some up to three times."""
    return mixing.apply(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row of the mix."""
    return bpe.digests(bpe.encode_decode(docs, VOCABULARY))


STAGES = [
    ("importance_resampling", keep_good),
    ("simhash_near_duplicates", drop_near_copies),
    ("fair_queue_mix", mix_sources),
    ("word_bpe_round_trip", encode),
]

# Hashed n-gram models, fingerprint components and byte-pair merges are beyond SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
