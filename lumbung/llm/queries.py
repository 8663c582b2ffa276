"""One query for each operator of this subpackage, on its whole table, and SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm import (
    bpe, embeddings, hard_negatives, language_id, line_dedup, minhash, oracles, packing, quality, secret_scan,
    spotsigs, substring_dedup, warc, whitening,
)
from lumbung.functions.storage import materialize
from lumbung.llm.common import documents

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialize(quality.statistics(documents(spark, sf_dir)), "statistics")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.score(stats, quality.fit(stats, labels))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = warc.capture_history(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return entries.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_likeness(documents(spark, sf_dir))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document after line dedup: what is left of it, and how much went."""
    before = documents(spark, sf_dir).select("doc_id", "text", F.length("text").alias("chars_before"))
    left = line_dedup.dedup_lines(before)
    return left.select(
        "doc_id",
        "chars_before",
        F.length("text").alias("chars_after"),
        (F.col("chars_before") > F.length("text")).alias("shortened"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def joined_spans(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("secret_spans", lambda s: s["rank"] < len(secret_scan.BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(rule.name).alias(f"n_{rule.name}") for rule in secret_scan.BASE],
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("secret_spans")).alias("spans"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), WORD_TOKENIZER)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), BYTE_RANKS, public_tokenizers.PATTERN)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.predict(docs, language_id.fit(docs))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=32)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document after substring dedup: how many words went, and what is left."""
    left = substring_dedup.dedup(documents(spark, sf_dir), window=50)
    return left.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth vector is an anchor; every seventh has the label after its own."""
    rows = hard_negatives.prepare(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op3_warc": op3_warc,
    "op4_spotsigs": op4_spotsigs,
    "op7_embeddings": op7_embeddings,
    "op2_line_dedup": op2_line_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_packing": op6_packing,
    "op8_minhash": op8_minhash,
    "op9_bpe": op9_bpe,
    "op10_language_id": op10_language_id,
    "op11_whitening": op11_whitening,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}
#: The others need compression, hashing, tokenizers or fitting; their tests compare with brute force.
ORACLES: dict[str, str] = {
    "op3_warc": oracles.WARC,
    "op5_secret_scan": oracles.secrets(),
    "op7_embeddings": oracles.EMBEDDINGS,
    "op8_minhash": oracles.MINHASH,
    "op12_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op13_hard_negatives": oracles.HARD_NEGATIVES,
}
