"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from probewatch.llm import (
    ann, codes, fingerprints, jaccard, licenses, middles, packing, pages, passages, quality, secrets, sharding,
    wordpieces,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ann_prefix_forest(spark, sf_dir):
    """The 20 nearest found of every query vector."""
    return ann.search(table(spark, sf_dir, "embeddings"))


def op2_license_scan(spark, sf_dir):
    """Places of license notices in all documents."""
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.notices(spark)).drop("text_hash")


def op3_ngram_jaccard_join(spark, sf_dir):
    """Near-duplicate component of every document."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op4_html_templates(spark, sf_dir):
    """Main text of every page."""
    return pages.extract(table(spark, sf_dir, "pages"))


def op5_best_fit_packing(spark, sf_dir):
    """Sequence and offset of every piece of every document."""
    files = corpus_pipeline.TOKENIZER_ADDED
    return packing.pack_documents(table(spark, sf_dir, "documents"), files)


def op6_quality_classifier(spark, sf_dir):
    """Quality score of every document."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_histogram_sharding(spark, sf_dir):
    """Shard and slot of every document."""
    return sharding.shard(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark, sf_dir):
    """Encoded and decoded length, checksum and equality of every document."""
    return wordpieces.round_trips(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_secret_scan(spark, sf_dir):
    """Secrets of every document."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_imatch_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op11_repeated_passages(spark, sf_dir):
    """What remains of every document without its repeated passages."""
    return passages.digests(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark, sf_dir):
    """Form, lengths and hashes of every document's fill-in-middle text."""
    return middles.digests(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark, sf_dir):
    """Code and errors of every vector."""
    return codes.codes(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f for f in (
        op1_ann_prefix_forest, op2_license_scan, op3_ngram_jaccard_join, op4_html_templates, op5_best_fit_packing,
        op6_quality_classifier, op7_histogram_sharding, op8_sentencepiece, op9_secret_scan, op10_imatch_fingerprints,
        op11_repeated_passages, op12_fill_in_middle, op13_vector_codes)
} | {"pipeline": corpus_pipeline.run}

ORACLES: dict[str, str] = {"op12_fill_in_middle": middles.SQL}
