"""A corpus from raw documents to token ids, in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dockpulse.llm import decontamination, near_dedup as jaccard_dedup, quality_rules, source_mixing, token_output
from dockpulse.llm.components import Written

# The tokenizer has no SQL form; tests compare the pipeline with a brute-force one.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more): the one with the smallest id."""
    return jaccard_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without items of the benchmark."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of small sources up to twice."""
    return source_mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the written token ids; repeated documents are written as often as they come."""
    return token_output.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix),
    ("token output", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage returns is written below the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = Written(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = kept.put(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
