"""From documents to training tokens: rules, near-duplicates, secrets, mixture, tokens.

Every stage takes all rows that its predecessor kept and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeload.llm import bpe, mixing, quality_rules, secrets, simhash
from lakeload.llm.common import dropped, stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.filter_docs(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates (three-word shingles, at most three bits), that of the
    smallest id."""
    return simhash.keep_one(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by a mark; n_chars follows the text."""
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of the sources: each document as often as its Poisson draw says, in random order."""
    return mixing.mix(docs).select(docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document (doc_id, n_tokens, ids) and the SHA-256 of the bytes they decode to."""
    path, pattern = bpe.vocabulary()
    return bpe.encode_docs(docs, path, pattern, outputs=("n_tokens", "ids", "decoded_sha256"))


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("secret scans", secret_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE encoding and decoding", token_stage),
]

# SQL can't express the fingerprints, the learned spans or the tokens; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages a table in the shared folder, so no stage repeats another's work.  A
    stage's table is removed when the next stage has written its own; the last one stays for the result that reads it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, path = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:
            dropped(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
