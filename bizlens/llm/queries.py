"""The registered queries of this package: each applies one operator, with its
production parameters, to the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bizlens.llm import (
    byte_bpe,
    exact_dedup,
    language_id,
    line_dedup,
    merkle,
    minhash,
    oracle,
    packing,
    resampling,
    sharding,
    signature_tree,
    spotsigs,
    suffix_dedup,
    toxicity,
)
from bizlens.llm.staging import documents


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers (on every node)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.round_trip(documents(spark, sf_dir), tokenizer_path("byte_bpe_multi_50k.tiktoken"),
                               public_tokenizers.PATTERN)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats_of_documents(documents(spark, sf_dir))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_of_documents(documents(spark, sf_dir))


def op6_spot_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprint_documents(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_of_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.lines_of_documents(documents(spark, sf_dir))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_documents(documents(spark, sf_dir))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_tree.jaccard_components(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_byte_bpe, op2_suffix_dedup, op3_minhash, op4_exact_dedup, op5_language_id, op6_spot_fingerprints,
        op7_toxicity, op8_line_dedup, op9_best_fit_packing, op10_sharding, op11_merkle_manifest, op12_importance_resampling,
        op13_ngram_jaccard_join)}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
