"""A corpus pipeline: each stage reads what the one before it wrote.

Defined cases, for every stage: a null or empty text is a document without
words, which the quality rules reject (later stages, given one, keep it); a
null ``doc_id`` is kept as it is and is the last of its near copies; a null
``source`` is a host of its own; equal rows are judged alike, and all rows of
the ``doc_id`` that stays of a group stay; ties between near copies go to the
least ``doc_id``; very long texts are worked on whole; all columns of the
documents are kept but by packing, whatever their names; an empty table stays
empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontamination, ngram_join, pii, quality, queries
from tessera.llm.shared import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines above their limits."""
    return quality.clean(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least ``doc_id``."""
    return ngram_join.first_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the terms that disclose it replaced."""
    return pii.sanitise(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return queries.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: Shingle links, edit distances and token ids are not for SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
