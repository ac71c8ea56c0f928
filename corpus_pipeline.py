"""A training-text pipeline: five stages over documents, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quotemill.llm import bpe, language_id, mixing, simhash, suffix_dedup
from quotemill.llm.queries import pattern, vocabulary
from quotemill.session import pinned


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language compression tells; the others go."""
    return language_id.keep_identified(docs, language_id.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def drop_repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that an earlier document has."""
    return suffix_dedup.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources takes them."""
    return mixing.repeat_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: tokens and the hashes of its ids and of what they decode to."""
    # Executors still hold what the stages before gathered, so workers remember fewer pre-tokens than by themselves.
    return bpe.round_trip(docs, vocabulary("byte_bpe_50k.tiktoken"), pattern(), remembered=100_000)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_text),
    ("source_mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: No SQL expresses compression, suffix arrays or merges; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = pinned(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
