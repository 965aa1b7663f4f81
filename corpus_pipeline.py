"""The corpus pipeline: toxicity, near duplicates, repeated passages, benchmark, tokens.

Every stage takes (spark, docs, sf_dir), works on all documents that its predecessor
kept, and is written before the next one reads it.  All but the last return the columns
of ``documents``; ``n_chars`` stays what it was in the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandspark.functions.stage import fresh_path, remove, staging
from demandspark.llm import bpe, decontam, ngram_join, suffix_dedup, toxicity
from demandspark.llm.common import table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the classifier learns from the labels of those that are there."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def one_near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays; five-word shingles, similarity of 0.8."""
    return ngram_join.one_of_each(docs, percent=80, words=5)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that also start earlier are taken out; every document stays."""
    return suffix_dedup.without_repeats(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark contaminates go."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document."""
    return bpe.encode(docs.select("doc_id", "text")).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_join", one_near_duplicate),
    ("suffix_dedup", without_repeated_passages),
    ("decontaminate", without_benchmark),
    ("bpe", tokens),
]

#: No SQL: stages are a trained classifier and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``, each written before the next; what a stage leaves behind goes, and so does its input."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, function in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        with staging(spark):
            function(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
