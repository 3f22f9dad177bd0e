"""Driver queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .bpe_words import encode_decode
from .common import documents
from .digest import fingerprint_documents
from .doc_trie import search_documents
from .html_extract import extract_pages
from .jaccard_join import jaccard_components
from .merkle import manifest
from .packing import pack_documents
from .resampling import resample
from .secret_scan import BASE_RULES, scan_documents, session_ledger, spans_text
from .sharding import shard_documents
from .substring_dedup import dedup_digest
from .token_counts import token_counts
from .weak_supervision import judge_quality

Query = Callable[[SparkSession, str], DataFrame]


def q_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_documents(documents(spark, sf_dir), session_ledger(spark))
    names = [r.name for r in BASE_RULES]

    def of(*kinds: str) -> Column:
        return F.filter("found", lambda x: x["rule"].isin(*kinds))

    counts = [F.size(of(n)).cast("long").alias(f"n_{n}") for n in names]
    return found.select("doc_id", *counts, F.sha2(spans_text(of(*names)), 256).alias("base_sha256"),
                        spans_text(F.col("found")).alias("spans"))


def q_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def q_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(documents(spark, sf_dir))


def q_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def q_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def q_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))


def q_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_digest(documents(spark, sf_dir), window=35)


def q_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), words=4, percent=85)


def q_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def q_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def q_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_secret_scans": q_secret_scans,
    "op2_bpe_words": q_bpe_words,
    "op3_quality_rules": q_quality_rules,
    "op4_rendezvous_sharding": q_sharding,
    "op5_substring_dedup": q_substring_dedup,
    "op6_token_counts": q_token_counts,
    "op7_importance_resampling": q_quality_classifier,
    "op8_best_fit_packing": q_packing,
    "op9_jaccard_join": q_jaccard_join,
    "op10_fingerprints": q_fingerprints,
    "op11_ranked_search": q_ranked_search,
    "op12_html_extraction": q_html_extraction,
    "op13_merkle_manifest": q_merkle_manifest,
}

# The others are not SQL (tokenizers, fitted models, digests, places of matches, CRC-32); they
# are tested against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op5_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op9_jaccard_join": oracle.JACCARD_JOIN,
    "op11_ranked_search": oracle.RANKED_SEARCH,
    "op13_merkle_manifest": oracle.MERKLE_MANIFEST,
}
