"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, fingerprints, lm_scoring, merkle, mixing, packing, pieces, quality, secrets, simhash, suffix_dedup, tokens, toxicity
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKEN_LIMIT = 512
SEQUENCE_LENGTH = 1024
REPEAT_BYTES = 200
SIMHASH_SHINGLE = 4
SIMHASH_BITS = 4


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token count, byte length and cut of every document."""
    return tokens.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), TOKEN_LIMIT)


@query
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces and their places in sequences."""
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE_LENGTH, keep_ids=False)


@query
def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, folder, "documents"), SIMHASH_SHINGLE, SIMHASH_BITS)


@query
def op3_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Sketch of every document and of its edited text, and their likeness."""
    return fingerprints.compared(table(spark, folder, "documents"))


@query
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of all sources takes from every document."""
    return mixing.mixed(table(spark, folder, "documents"))


ORACLES["op5_mixing"] = mixing.oracle()


@query
def op8_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets in every document."""
    return secrets.scanned(table(spark, folder, "documents"))


ORACLES["op8_secret_scans"] = secrets.oracle()


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, perplexity and verdict of every document."""
    return quality.verdicts(table(spark, folder, "documents"))


@query
def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of every document, from the documents that are not held out."""
    return lm_scoring.scores(table(spark, folder, "documents"))


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels that are not held out."""
    return toxicity.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op4_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the byte strings that repeat."""
    done = suffix_dedup.deduplicated(table(spark, folder, "documents"), REPEAT_BYTES)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proof of every document in the manifest, and whether it holds for the document as it is now."""
    docs = table(spark, folder, "documents")
    found = merkle.manifest(docs, altered={"now": merkle.tampered(docs)})
    return merkle.proofs(found, "now").select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Links between the tokens of two tokenizers in every document, and how common they are."""
    made = alignment.alignments(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                public_tokenizers.path("piece_bpe_32k.model"), digests=True)
    return made.withColumnRenamed("groups", "groups_sha256")


@query
def op13_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    made = pieces.encoded(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return made.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
