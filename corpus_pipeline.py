"""The training-data pipeline: documents to packed sequences in five stages.

Each stage function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the columns of
``documents``.

1. quality classifier: documents that importance resampling does not draw go
2. n-gram Jaccard join: one document of each group of near copies (five words, similarity
   0.8 or more) stays
3. substring dedup: words of 35-word windows that repeat anywhere are cut out of the texts;
   a document of which nothing is left stays as an empty text
4. secret scans: spans are replaced by a mark
5. best-fit packing: token pieces with their places in sequences of 2048
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm.common import documents, staged
from farebox.llm.jaccard_join import keep_one_of_each
from farebox.llm.packing import pack_documents
from farebox.llm.resampling import keep_resampled
from farebox.llm.secret_scan import redact_documents, session_ledger
from farebox.llm.substring_dedup import remove_repeats


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_resampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs, words=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(remove_repeats(docs, window=35))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(redact_documents(docs, session_ledger(spark)))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("jaccard_join", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

# Importance resampling and packing are not SQL; tests/llm/test_pipeline.py checks every
# stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each stage's result stored before the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
