"""A training corpus from raw documents: five stages, each a written table.

1. language ID: documents without a letter, or without text, go.
2. line dedup: lines whose template recurs in many documents stay in the first.
3. MinHash near-dedup: of each group of near-duplicates the first document stays.
4. suffix-array dedup: strings of 50 bytes that a smaller document has go.
5. best-fit packing: what is left is cut, packed and returned as pieces.

All but the last return the columns of ``documents``; a document whose text a
stage changes keeps its other columns, and ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bizlens.llm import language_id, line_dedup, minhash, packing, staging, suffix_dedup
from bizlens.llm.queries import tokenizer_path

#: Least Jaccard of near-duplicates, in percent; op3_minhash has its own.
NEAR_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.drop_undetermined(docs)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_recurring(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_first(docs, NEAR_PERCENT)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_recurring_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_strings),
    ("best_fit_packing", pack_sequences),
]

#: The stages learn, hash and sort in ways that SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = staging.documents(spark, sf_dir)
    for name, stage in STAGES:
        path = staging.run_path(spark, f"pipeline-{name}")
        with staging.scratch(spark):  # what a stage has written on its way goes when its result is stored
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
