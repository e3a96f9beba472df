"""From raw documents to packed training sequences."""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession

from phrasetide.llm import exact_dedup, language, minhash, packing
from phrasetide.llm.common import ship_code, table, written


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language; those without letters go."""
    return language.with_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, by shingles of five words."""
    return minhash.keep_one(docs, size=5)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2,048 ids."""
    return packing.packed_pieces(docs, path("word_bpe_49k.json"))


STAGES = [("language", languages), ("exact", exact), ("near", near), ("pack", pack)]

# Language models, hashing and tokenisers are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(ship_code(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
