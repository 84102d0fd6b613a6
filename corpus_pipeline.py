"""A training corpus in stages, each one operator of ``millrace.llm`` on what the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, exact_dedup, jaccard_join, language_id, packing
from millrace.llm._scratch import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those that are NULL, empty or without a letter go."""
    model = language_id.fit(docs.filter(~language_id.in_fold("doc_id", 3, 1)))
    return language_id.identify(docs, model).filter(F.col("lang_pred") != language_id.UNKNOWN).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts one stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with similar shingle sets the one with the smallest doc_id stays."""
    return jaccard_join.keep_representatives(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in sequences of 4096 tokens."""
    return packing.pack(packing.tokenized_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("language ID", keep_identified),
    ("exact dedup", drop_copies),
    ("jaccard join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: A classifier, a tokenizer and alignments are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn on ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
