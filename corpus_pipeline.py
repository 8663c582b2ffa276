"""The corpus pipeline: language ID, line dedup, near-dedup, secret scan, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that `run` writes as Parquet in the
shared folder and reads again for the next stage, so a lost executor costs at most the running stage.
All stages but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumbung.functions.storage import materialize
from lumbung.llm import language_id, line_dedup, minhash, packing, secret_scan
from lumbung.llm.common import documents
from lumbung.llm.queries import WORD_TOKENIZER


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose best language saves too little over the second, go."""
    return language_id.keep_identified(docs, language_id.fit(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines go but for their first occurrence, and documents emptied by that."""
    return line_dedup.dedup_lines(docs, drop_emptied=True)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document with their sequence of at most 4096 tokens and place in it."""
    return packing.pack_documents(docs, WORD_TOKENIZER)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", dedup_documents),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]
#: Compression, hashing and tokenization are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
