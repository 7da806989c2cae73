"""Corpus pipeline: the stages that turn raw documents into token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which
:func:`run` writes as Parquet to the shared folder and reads again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fjord.llm import chunkbpe, exactdup, mixing, quality, simhash
from fjord.llm.common import stage, table
from fjord.llm.queries import bpe_digest


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects (score below 0.3) go; empty and null texts are scored too."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (after lower-casing A-Z) the row with the largest doc_id stays."""
    return exactdup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked by 3 or fewer bits the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents, 70 % of the tokens, raked to tempered source, language and topic shares."""
    return mixing.sample(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: their number and digest, and that of the decoded text."""
    return bpe_digest(chunkbpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality classifier", good),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing to target weights", mixed),
    ("BPE encoding", encoded),
]

# Classifier, fingerprints and tokeniser have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
