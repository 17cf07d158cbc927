"""From raw documents to token ids, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet in the shared folder and reads again as the next one's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medframe.llm import bpe, mixing, neardup, pii, quality
from medframe.llm.batches import remove, store

LEAST_QUALITY = 0.3
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.keep(docs, labels, LEAST_QUALITY)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.keep_one(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced; ``n_chars`` follows the text."""
    return pii.redact(docs).withColumn(
        "n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.repeat(docs)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids instead of texts, checked by decoding them."""
    return bpe.tokenise(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


STAGES = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("redact_pii", redact_pii),
    ("mix_sources", mix_sources),
    ("encode_bpe", encode_bpe),
]

ORACLE_SQL = None  # no stage but the rules of the mix can be said in SQL; tests/llm compares by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs, path = store(stage(spark, docs, sf_dir), name)
        if before:
            remove(spark, before)
        before = path
    return docs
