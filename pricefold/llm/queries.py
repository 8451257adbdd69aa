"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricefold.llm import (
    contamination,
    cover_tree,
    language,
    merkle,
    mixing,
    near_duplicates,
    personal_data,
    prefix_trie,
    ring,
    token_counts,
    token_files,
    warc,
    whitening,
)

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
END_ID = 2
SHARDS = 40
COMPONENTS = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.prefix_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), budget=TOKEN_LIMIT
    )
    return counted.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
        F.col("within_budget").alias("chars_within_limit"), "prefixes",
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return language.identified(docs).select("doc_id", F.col("lang").alias("declared"), "identified.*")


def pages_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3 over all pages, with the language that the markup declares and the address suffix."""
    pages = language.page_evidence(table(spark, sf_dir, "pages"))
    found = language.identified(pages, declared="declared", host="host", suffix="suffix")
    return found.select("page_id", "declared", "host", "suffix", "identified.*")


def op4_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.sharded(table(spark, sf_dir, "documents"), shards=SHARDS)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.token_files(docs, public_tokenizers.path(TOKENIZER), END_ID)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the schedule positions of the first slots that take the document, the first and the last time."""
    found = mixing.mixed(table(spark, sf_dir, "documents"))
    ends = F.array_min("slots").alias("first_slot"), F.array_max("slots").alias("last_slot")
    return found.select("doc_id", "size", "source_size", "target", "taken", *ends)


def op7_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination.contaminated(docs, benchmark).drop("seen")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), *[f"n_{kind}" for kind in personal_data.KINDS],
        F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_secret", "secrets",
    )


def op9_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.linked_vectors(table(spark, sf_dir, "embeddings"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents")).drop("seen", "group")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_fingerprints(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator's deviation is an exact decimal; here, one that passes 64 bits is null."""
    found = whitening.whitened(table(spark, sf_dir, "embeddings"), COMPONENTS)
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_warc": op2_warc,
    "op3_language": op3_language,
    "pages_language": pages_language,
    "op4_ring": op4_ring,
    "op5_token_files": op5_token_files,
    "op6_mixing": op6_mixing,
    "op7_contamination": op7_contamination,
    "op8_personal_data": op8_personal_data,
    "op9_cover_tree": op9_cover_tree,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_merkle": op11_merkle,
    "op12_whitening": op12_whitening,
    "op13_prefix_trie": op13_prefix_trie,
}
