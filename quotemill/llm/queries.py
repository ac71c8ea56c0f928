"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, importance, language_id, licenses, mixing, periodic_runs, quality_model, quality_rules, simhash, substring_dedup, suffix_dedup, token_store, topk
from .common import crc32

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def held_out(parts: int, remainder: int):
    """Rows of the test fold: those whose id's checksum leaves this remainder."""
    return F.coalesce(crc32("doc_id") % parts == remainder, F.lit(False))


def op1_topk(spark, sf):
    return topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op2_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents"), weights=(5.0, 2.0, 1.0), share=1.0, most_epochs=3).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op3_suffix_dedup(spark, sf):
    return suffix_dedup.removals(table(spark, sf, "documents"), length=50).drop("kept")


def op4_simhash(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"), width=4, budget=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_bpe(spark, sf):
    return bpe.round_trip(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.tiktoken"), pattern())


def op6_licenses(spark, sf):
    return licenses.scan(table(spark, sf, "documents"))


def op7_quality_rules(spark, sf):
    return quality_rules.judge(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_token_store(spark, sf):
    return token_store.store_and_read(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"), end=2)


def op9_quality_model(spark, sf):
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").where(~held_out(3, 1))
    model = quality_model.train(quality_model.sample(docs, labels))
    return quality_model.score(docs, model).select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")


def op10_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    dictionaries = language_id.fit(docs.where(~held_out(4, 2)))
    found = language_id.predict(docs, dictionaries)
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "rejected")


def op11_importance(spark, sf):
    found = importance.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"), grams=1, buckets=10_000, least_words=20, percent=10, seed=2024)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_substring_dedup(spark, sf):
    return substring_dedup.removals(table(spark, sf, "documents"), window=13).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op13_periodic_runs(spark, sf):
    return periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.planted(table(spark, sf, "documents")), least=12))


def pipeline(spark, sf):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_topk, op2_mixing, op3_suffix_dedup, op4_simhash, op5_bpe, op6_licenses, op7_quality_rules, op8_token_store, op9_quality_model, op10_language_id, op11_importance, op12_substring_dedup, op13_periodic_runs, pipeline)
}
