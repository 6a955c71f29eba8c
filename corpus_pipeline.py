"""A corpus pipeline of five of the operators, from documents to packed sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wastelake.llm import common, mixing, packing, quality, secrets, simhash
from wastelake.session import cut

SHINGLE, MAX_BITS = 4, 4
LENGTH = 1024


def quality_kept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    common.prepare(spark)
    return quality.kept(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    common.prepare(spark)
    return simhash.one_of_each(docs, SHINGLE, MAX_BITS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark."""
    common.prepare(spark)
    return secrets.redacted(docs, length="n_chars")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as the mix has it."""
    common.prepare(spark)
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    common.prepare(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), LENGTH, keep_ids=False)


STAGES = [
    ("quality_rules", quality_kept),
    ("simhash_near_dedup", distinct),
    ("secret_scans", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]
#: No SQL: model, fingerprints and tokens are not expressible; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; each result is written and read again as the next one's documents."""
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
