"""A training corpus from ``documents``: quality, exact copies, near copies, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next
one's docs. All but the last return rows of ``documents`` as they are; the last has the tokens of each text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfcount.llm import bpe, decontaminate, exact, minhash, quality, simhash
from shelfcount.llm.queries import MULTI, table
from shelfcount.llm.textbytes import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the least doc_id."""
    return exact.without_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, by fingerprint or by shingles of five words, the one with the least doc_id."""
    return simhash.one_of_each(docs, minhash.links)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256)"""
    return bpe.encode_decode(docs, public_tokenizers.path(MULTI), public_tokenizers.PATTERN)


STAGES = [("quality", quality_stage), ("exact", exact_stage), ("near", near_stage), ("benchmark", benchmark_stage),
          ("tokens", tokens_stage)]

#: The classifier, the shingle hashes and the byte pairs are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
