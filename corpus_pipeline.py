"""Training-corpus pipeline: quality, near duplicates, secrets, packing.

Every stage takes all rows that its predecessor kept.  All but the last return the columns
of documents; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from probewatch.llm import jaccard, packing, quality, secrets
from probewatch.llm.common import settle

#: A name, the vocabulary as ranks and its word pattern.
TOKENIZER = ("byte_bpe_50k", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
#: The same with the added tokens that the vocabulary's json lists.
TOKENIZER_ADDED = (*TOKENIZER, public_tokenizers.path("byte_bpe_50k.json"))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; different texts of one id are told apart."""
    return jaccard.distinct_documents(docs)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced by a mark."""
    return secrets.redact(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return packing.pack_documents(docs, TOKENIZER_ADDED)


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_masking),
    ("packing", packed_sequences),
]

#: Learned models, graph components and tokenizers have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
