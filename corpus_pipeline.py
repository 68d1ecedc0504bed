"""The corpus pipeline: the documents table through five operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read back as the next one's docs.  All but the last return the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from formsieve.llm import language, line_dedup, mixing, packing, simhash
from formsieve.llm.common import saved

WORD_VOCABULARY = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (null text, or no letter) go."""
    return language.drop_unknown(docs, language.training_texts(language.learned_rows(docs)))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents share stay in the largest doc id only."""
    return line_dedup.drop_lines(docs, line_dedup.keep_bitmaps(docs))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: four-word shingles, at most 4 bits apart."""
    return simhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources come to their target words."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document (and of every repetition) with its sequence and place."""
    return packing.pack(docs, public_tokenizers.path(WORD_VOCABULARY))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup_stage), ("simhash_dedup", simhash_dedup),
          ("source_mix", source_mix), ("best_fit_packing", best_fit_packing)]

#: Suffix automata, fingerprint components and randomised rounding have no SQL; tests/llm holds
#: the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table through every stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
