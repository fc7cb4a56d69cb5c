"""A corpus from raw documents: the stages in order, each a Spark job over what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evgraph.llm import jaccard_join, langid, line_dedup, mixing, packing, token_counts
from evgraph.llm.steps import prepared
from evgraph.session import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language stays unclear, go."""
    prepared(spark)
    return langid.reject_unknown(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines within two edits of an earlier line go, and documents that keep no word."""
    prepared(spark)
    return line_dedup.dedup(docs)


def jaccard_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words a shingle, a similarity of 0.8 or more."""
    prepared(spark)
    return jaccard_join.one_of_each(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by target weight: documents go, stay, or stay more than once."""
    prepared(spark)
    return mixing.resample(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    prepared(spark)
    return packing.pack(docs, token_counts.vocabulary("word_bpe_49k.json"), 4096)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", jaccard_join_stage),
    ("mixing sources to target weights", mixing_weights),
    ("best-fit packing", best_fit_packing),
]

# Tokens, language models and edit distances are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole ``documents`` table."""
    docs = prepared(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
